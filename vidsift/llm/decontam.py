"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item that occurs in a document within k edits keeps at least one of k + 1 pieces intact. All pieces of a
block of items go into one automaton; a piece found in a document proposes a window, and Myers' bit-parallel distance
decides whether the item ends in it within k edits. Items are a stated query set: they come in blocks of bounded size,
each block scans all documents, so neither the number of items nor of documents is limited.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, tidy

BLOCK_CHARS = 4_000_000
SCHEMA = "doc_id long, item_id long, distance int, end_char long"


def normal(text: str) -> str:
    """Lower case, white space as single blanks; distances and positions refer to this form."""
    return " ".join(text.lower().split())


def budget(length: int, rate: float, least_piece: int) -> int:
    """Edits allowed to an item: a share of its length, with no piece shorter than ``least_piece``."""
    return max(0, min(int(rate * length), length // least_piece - 1))


def best_end(masks: dict[str, int], m: int, text: str, k: int) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of text, where the first such ends); distance k + 1 if above k."""
    ones = (1 << m) - 1
    top = 1 << (m - 1)
    pv, mv, score, best, end = ones, 0, m, k + 1, -1
    get = masks.get
    for at, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (ones & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, at
        ph = (ph << 1) & ones
        pv = ((mh << 1) & ones) | (ones & ~(xv | ph))
        mv = ph & xv
    return best, end


class Matcher:
    """Finds items of one block; items are (id, normalised text) pairs, empty ones are left out."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_piece: int):
        import ahocorasick

        same: dict[str, list[int]] = {}
        for i, text in items:
            if text:
                same.setdefault(text, []).append(i)
        self.texts, self.ids = list(same), list(same.values())
        self.k = [budget(len(t), rate, least_piece) for t in self.texts]
        self.masks: dict[int, dict[str, int]] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (t, k) in enumerate(zip(self.texts, self.k, strict=True)):
            cuts = [len(t) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(t[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for p, where in pieces.items():
            self.automaton.add_word(p, (len(p), where))
        self.automaton.make_automaton()

    def masks_of(self, n: int) -> dict[str, int]:
        if n not in self.masks:
            out: dict[str, int] = {}
            for i, c in enumerate(self.texts[n]):
                out[c] = out.get(c, 0) | 1 << i
            self.masks[n] = out
        return self.masks[n]

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """Of a normalised text: item number -> (distance, end) of its best match within budget."""
        if not len(self.automaton):
            return {}
        windows: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for n, a in where:
                start, k = end + 1 - size - a, self.k[n]
                lo, hi = max(0, start - k), min(len(text), start + len(self.texts[n]) + k)
                runs = windows.setdefault(n, [])
                if runs and runs[-1][0] <= lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                elif not runs or lo < runs[-1][0] or lo > runs[-1][1]:
                    runs.append([lo, hi])
        found: dict[int, tuple[int, int]] = {}
        for n, runs in windows.items():
            item, k = self.texts[n], self.k[n]
            for lo, hi in runs:
                limit = found[n][0] - 1 if n in found else k
                if limit < 0:
                    break
                if (at := text.find(item, lo, hi)) >= 0:
                    d, end = 0, at + len(item)
                elif limit == 0:
                    continue
                else:
                    d, end = best_end(self.masks_of(n), len(item), text[lo:hi], limit)
                    end += lo
                if d <= limit:
                    found[n] = (d, end)
        return found


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of at most ``limit`` characters, or one item; null ids and texts are left out."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").orderBy("i", "t")
    block: list[tuple[int, str]] = []
    size = 0
    for r in rows.toLocalIterator():
        t = normal(r.t)
        if block and size + len(t) > limit:
            yield block
            block, size = [], 0
        block.append((r.i, t))
        size += len(t)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = 0.08, least_piece: int = 10) -> DataFrame:
    """(doc_id, item_id, distance, end_char): each document row and item that occurs in it within the item's budget.

    Null and empty documents and items match nothing; items with equal text each get a row; repeated document rows
    each get theirs; no documents or no items give no rows.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def scan(block):
        def rows(batches):
            m = Matcher(block, rate, least_piece)
            for b in text_batches(batches):
                out = []
                for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    if t:
                        for n, (dist, end) in m.find(normal(t)).items():
                            out += [(i, item, dist, end) for item in m.ids[n]]
                yield pa.record_batch([pa.array([x[j] for x in out], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "item_id", "distance", "end_char"])

        return d.mapInArrow(tidy(rows), SCHEMA)

    blocks = [scan(b) for b in item_blocks(benchmark)]
    return reduce(DataFrame.unionByName, blocks) if blocks else d.sparkSession.createDataFrame([], SCHEMA)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = 0.08, least_piece: int = 10) -> DataFrame:
    """The rows of docs in which no item occurs, unchanged; null and empty texts are clean."""

    def keep(block):
        def rows(batches):
            m = Matcher(block, rate, least_piece)
            for b in text_batches(batches, text=text):
                yield b.filter(pc.invert(pa.array([bool(t) and bool(m.find(normal(t))) for t in b.column(text).to_pylist()], pa.bool_())))

        return tidy(rows)

    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
