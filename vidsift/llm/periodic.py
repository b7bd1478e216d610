"""Periodic runs of words, by Crochemore's partition refinement.

Positions of a text are kept in classes of equal factors of L words, refined from L to L + 1. Of the parts of a class
that splits, all but the largest are "small"; only the predecessors of small parts are looked at in the next step
(smaller half), so a position is moved at most log(n) times. Inside a class positions are linked in their order. Two
neighbours of a class at distance L when classes hold factors of L words are a square, and its root is primitive,
because a shorter period would put a nearer neighbour between them. Squares of one period at consecutive positions
are one maximal run.

The texts of a batch are refined side by side: a class never holds positions of two texts, and all steps are array
operations over the positions that move.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import strings, text_batches, tidy, words

#: Positions, classes and successors are packed into one integer as long as each fits so many bits.
BITS = 21


class _Due:
    """Neighbour distances by the length at which they are to be looked at, held in windows that grow with the length."""

    def __init__(self):
        self.later: list[tuple[np.ndarray, np.ndarray]] = []
        self.by_gap: dict[int, list[np.ndarray]] = {}
        self.end = 1

    def add(self, gap: np.ndarray, at: np.ndarray) -> None:
        now = gap < self.end
        if not now.all():
            self.later.append((gap[~now], at[~now]))
            gap, at = gap[now], at[now]
        if len(gap):
            o = np.argsort(gap, kind="stable")
            gap, at = gap[o], at[o]
            cuts = np.flatnonzero(np.diff(gap)) + 1
            for g, part in zip(gap[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
                self.by_gap.setdefault(g, []).append(part)

    def take(self, length: int, nxt: np.ndarray) -> np.ndarray:
        """Positions whose neighbour is ``length`` away, in order."""
        if length >= self.end:
            held, self.later, self.end = self.later, [], length + max(64, length // 4)
            if held:
                gap, at = (np.concatenate(x) for x in zip(*held, strict=True))
                valid = nxt[at] - at == gap  # a distance that has grown since was added anew
                self.add(gap[valid], at[valid])
        parts = self.by_gap.pop(length, None)
        if parts is None:
            return np.empty(0, np.int64)
        at = np.unique(np.concatenate(parts))
        return at[nxt[at] - at == length]


def _sorted(n: int, *keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """The columns given, ordered by the first, then the next; all below n."""
    if n < 1 << BITS and len(keys) <= 3:
        packed = keys[0]
        for k in keys[1:]:
            packed = packed << BITS | k
        packed = np.sort(packed)
        mask = (1 << BITS) - 1
        return tuple(packed >> BITS * (len(keys) - 1 - i) & mask for i in range(len(keys)))
    o = np.lexsort(keys[::-1])
    return tuple(k[o] for k in keys)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), then those of the next."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Classes:
    """Classes of equal factors over several texts, each ended by a word of its own."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, most: np.ndarray):
        """``codes`` of all words, ``first`` word of each text and the end, ``most``: longest period wanted of each."""
        docs = len(first) - 1
        length = np.diff(first) + 1
        self.begin = np.concatenate([[0], np.cumsum(length)])
        self.n = n = int(self.begin[-1])
        doc = np.repeat(np.arange(docs), length)
        self.ends = np.zeros(n, bool)
        self.ends[self.begin[1:] - 1] = True
        kinds = int(codes.max(initial=0)) + 2
        word = np.full(n, kinds - 1, np.int64)
        word[~self.ends] = codes
        self.most = most[doc]
        _, self.cls = np.unique(doc * kinds + word, return_inverse=True)
        self.cls = self.cls.astype(np.int64)
        self.used = int(self.cls.max(initial=-1)) + 1
        self.start, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        held = np.bincount(self.cls, minlength=self.used)
        self.size[: self.used] = held
        self.start[: self.used] = np.cumsum(held) - held
        self.order = np.argsort(self.cls, kind="stable")
        self.where = np.empty(n, np.int64)
        self.where[self.order] = np.arange(n)
        self.mark = np.zeros(n, bool)
        self.nxt, self.prv = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.due = _Due()
        at = self.order
        self._link(at, self.cls[at])
        self._push(at[self.nxt[at] >= 0], 1)
        # all classes of a text but its largest are small
        class_doc = doc[at[self.start[: self.used]]]
        o = np.lexsort((-held, class_doc))
        largest = np.zeros(self.used, bool)
        largest[o[np.concatenate([[True], np.diff(class_doc[o]) != 0])] if len(o) else o] = True
        self.small = np.flatnonzero(~largest[self.cls])

    def _link(self, at: np.ndarray, ids: np.ndarray) -> None:
        """Link positions, given in order class by class, to their neighbours."""
        same = ids[1:] == ids[:-1]
        self.nxt[at] = -1
        self.prv[at] = -1
        self.nxt[at[:-1][same]] = at[1:][same]
        self.prv[at[1:][same]] = at[:-1][same]

    def _push(self, at: np.ndarray, least: int) -> None:
        gap = self.nxt[at] - at
        keep = (gap >= least) & (gap <= self.most[at])
        if keep.any():
            self.due.add(gap[keep], at[keep])

    def refine(self, length: int) -> None:
        """From factors of ``length`` words to those of one more."""
        at = self.small - 1
        at = at[at >= 0]
        at = at[~self.ends[at] & (self.size[self.cls[at]] > 1) & (self.most[at] > length)]
        self.small = at[:0]
        if not len(at):
            return
        c, succ, at = _sorted(self.n, self.cls[at], self.cls[at + 1], at)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (c[1:] != c[:-1]) | (succ[1:] != succ[:-1])
        g_first = np.flatnonzero(fresh)
        g_size = np.diff(np.append(g_first, len(at)))
        g_class = c[g_first]
        k_first = np.flatnonzero(np.concatenate([[True], g_class[1:] != g_class[:-1]]))  # the first group of each class
        k_groups = np.diff(np.append(k_first, len(g_first)))
        ids = g_class[k_first]
        touched = np.add.reduceat(g_size, k_first)
        rest = self.size[ids] - touched
        split = (rest > 0) | (k_groups > 1)
        if not split.all():
            keep_g = np.repeat(split, k_groups)
            keep = np.repeat(keep_g, g_size)
            at, c = at[keep], c[keep]
            g_size, g_class = g_size[keep_g], g_class[keep_g]
            ids, touched, rest, k_groups = ids[split], touched[split], rest[split], k_groups[split]
            if not len(ids):
                return
            k_first = np.cumsum(k_groups) - k_groups
        g = len(g_size)
        best = np.maximum.reduceat(g_size * g + (g - 1 - np.arange(g)), k_first)
        largest, which = best // g, g - 1 - best % g
        by_rest = rest >= largest  # who keeps the class's id: what was not touched, or the largest group
        new = np.ones(g, bool)
        new[which[~by_rest]] = False
        g_id = np.where(new, 0, g_class)
        g_id[new] = self.used + np.arange(new.sum())
        self.used += int(new.sum())
        parted = ~by_rest & (rest > 0)
        rest_id = self.used + np.arange(parted.sum())
        self.used += int(parted.sum())

        # touched positions go to the end of their class's stretch of ``order``
        s = self.start[ids]
        tail = s + rest
        slots = _spans(tail, touched)
        from_ = self.where[at]
        front = from_ < np.repeat(tail, touched)
        self.mark[at] = True
        there = self.order[slots]
        out = there[~self.mark[there]]
        self.mark[at] = False
        self.order[from_[front]] = out
        self.where[out] = from_[front]
        self.order[slots] = at
        self.where[at] = slots
        rests = self.order[_spans(s[parted], rest[parted])]
        self.start[g_id] = slots[np.cumsum(g_size) - g_size]
        self.size[g_id] = g_size
        self.size[ids[by_rest]] = rest[by_rest]
        self.start[rest_id], self.size[rest_id] = s[parted], rest[parted]

        # small parts leave the links of their class and are linked among themselves
        moved = np.repeat(new, g_size)
        gone = np.concatenate([at[moved], rests])
        gone_id = np.concatenate([np.repeat(g_id, g_size)[moved], np.repeat(rest_id, rest[parted])])
        old, gone_ = _sorted(self.n, self.cls[gone], gone)
        self.mark[gone] = True
        before, after = self.prv[gone_], self.nxt[gone_]
        heads = before[(before < 0) | ~self.mark[before]]
        tails = after[(after < 0) | ~self.mark[after]]
        self.mark[gone] = False
        self.nxt[heads[heads >= 0]] = tails[heads >= 0]
        self.prv[tails[tails >= 0]] = heads[tails >= 0]
        if len(rests):
            gone_id, gone = _sorted(self.n, gone_id, gone)
        self._link(gone, gone_id)
        self.cls[gone] = gone_id
        near = heads[(heads >= 0) & (tails >= 0)]
        self._push(np.concatenate([near, gone[self.nxt[gone] >= 0]]), length + 1)
        self.small = gone


def runs(codes: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all maximal runs of at least ``least`` words and ``times`` periods.

    ``codes`` are the words of several texts, ``first`` the first word of each text and the end. A run's period is its
    smallest one. Ordered by text, start, period.
    """
    n = np.diff(first)
    most = np.where(n >= least, n // times, 0)
    state = _Classes(codes, first, most)
    found = []
    length, last = 1, int(most.max(initial=0))
    while length <= last:
        at = state.due.take(length, state.nxt)
        if len(at):
            cut = np.flatnonzero(np.diff(at) > 1) + 1
            begins, counts = at[np.concatenate([[0], cut])], np.diff(np.concatenate([[0], cut, [len(at)]]))
            size = counts - 1 + 2 * length
            long = size >= max(least, times * length)
            if long.any():
                found.append((begins[long], size[long], np.full(int(long.sum()), length)))
        state.refine(length)
        if not len(state.small):
            # nothing can split any more; only texts whose longest period is reached still hold larger classes
            last = min(last, length + 1)
        length += 1
    if not found:
        return (np.empty(0, np.int64),) * 4
    start, size, period = (np.concatenate(x) for x in zip(*found, strict=True))
    text = np.searchsorted(state.begin, start, "right") - 1
    start = start - state.begin[text]
    o = np.lexsort((period, start, text))
    return text[o], start[o], size[o], period[o]


def _rows(texts: pa.Array, least: int, times: int) -> list[pa.Array]:
    first, codes, kinds = words(texts)
    n = np.diff(first)
    text, start, size, period = runs(codes, first, least, times)
    offsets = np.searchsorted(text, np.arange(len(n) + 1))
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, size, period)], ["start", "length", "period"])
    # +1 where a run's repetitions begin, -1 behind its end
    depth = np.zeros(len(codes) + 1, np.int64)
    np.add.at(depth, first[text] + start + period, 1)
    np.add.at(depth, first[text] + start + size, -1)
    keep = np.cumsum(depth)[:-1] == 0
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    left = kinds.take(pa.array(codes[keep]))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_before[first], pa.int32()), left), pa.scalar(" ", left.type))
    return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), joined.cast(pa.string())]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) for each row of docs.

    Words are what lies between ASCII white space. A run is a stretch of ``least`` words and ``times`` periods at least
    that no neighbouring word extends; ``collapsed`` is the text without the words that any run holds after its first
    period, joined by single spaces. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated
    rows each give a row; other columns of docs are ignored. A text is one row of one task and takes n log n steps.
    """

    def rows(batches):
        for b in text_batches(batches, 6_000_000):
            yield pa.record_batch([b.column("doc_id"), *_rows(strings(b.column("text")), least, times)], names=["doc_id", "n_words", "runs", "collapsed"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(tidy(rows), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
