"""Repeated passages by sparse suffix arrays.

Of every text only the suffixes at minimiser positions are kept: a position whose hash of the next ``GRAM`` words is
least in some window of words. Two texts that share a passage of ``least`` words share its windows, so both keep a
suffix at the same place in it. Suffixes whose first words occur in one document only are dropped; the others carry
up to ``least - GRAM`` words on either side, are sorted by the words that follow and, again, by the words that
precede, and each is compared with its neighbours of other documents and extended left and right. What adds up to
``least`` words or more is a repeated passage. A suffix of a group of three or more may share its passage with one that
is next to it in neither order, so what neighbours leave open is sorted once more for each split of ``least`` words
into those before and after the first words; equal neighbours in these orders settle the rest.

Words are compared by 32-bit hashes, a passage by at least ``least`` of them in a row. Work and storage follow the
number of kept suffixes; no pairs of a group are listed. A first-words group of more than ``GROUP`` suffixes is dealt by
document over several tasks; each hands on its different splits once, and those that several tasks hold meet in a
partial aggregate, so dealing loses no passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, partitions, strings, text_batches, tidy, words

GRAM = 8
LEAST = 50
GROUP = 20_000
SALTS = 16
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's first word number (and the end), each word's 32-bit hash."""
    first, codes, dictionary = words(texts)
    table = np.fromiter((xxhash.xxh32_intdigest(w) for w in dictionary.cast(pa.large_binary()).to_pylist()), np.uint32, len(dictionary))
    return first, table[codes]


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over a[i : i + width] for each i that has a full window."""
    done, out = 1, a
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = op(out[: len(a) - width + 1], out[width - done : width - done + len(a) - width + 1])
    return out


def anchors(first: np.ndarray, h: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of the minimiser positions, hash of the words there) over all texts of a batch.

    Texts of fewer than ``least`` words have none; of equal hashes in a window all count.
    """
    n, width = len(h), least - gram + 1
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        g += h[j : n - gram + 1 + j].astype(np.uint64) * _MULT[j]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    g |= np.uint64(1)  # zero marks windows that no text holds
    low = _sliding(g, width, np.minimum)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low[doc[: n - least + 1] != doc[least - 1 :]] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_sliding(padded, width, np.maximum)[: len(g)] == g)
    return at, g[at]


def _doc_keys(b: pa.RecordBatch, texts: pa.Array) -> np.ndarray:
    ids = b.column("doc_id").to_pylist()
    raw = texts.cast(pa.large_binary()).to_pylist()
    return np.fromiter((xxhash.xxh64_intdigest(t, 0 if i is None else (i * 2 + 1) & (2**64 - 1)) for i, t in zip(ids, raw, strict=True)), np.uint64, len(ids)).view(np.int64)


def _common(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Length of the common start of each pair of rows of words, given how many words each row has."""
    differ = a != b
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(n, np.minimum(na, nb))


def _passages(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray, nl: np.ndarray, nr: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, start, end) of the passages that neighbours in both orders prove, and which rows they prove in full."""
    rows, starts, ends = [], [], []
    full = np.zeros(len(key), bool)
    for main, n_main in ((right, nr), (left, nl)):
        image = np.concatenate([key[:, None].view(np.uint32).astype(">u4"), main.astype(">u4"), n_main[:, None].astype(">u4"), doc[:, None].view(np.uint32).astype(">u4")], axis=1)
        order = np.argsort(np.ascontiguousarray(image).view(f"V{image.shape[1] * 4}").reshape(-1), kind="stable")
        n = len(order)
        d, k = doc[order], key[order]
        same = np.zeros(n, bool)
        same[1:] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
        # the last row before, and the first after, of another document
        prev = np.maximum.accumulate(np.where(same, -1, np.arange(n))) - 1
        start_next = np.concatenate([np.flatnonzero(~same), [n]])
        nxt = start_next[np.searchsorted(start_next, np.arange(n), side="right")]
        for other in (prev, nxt):
            ok = (other >= 0) & (other < n)
            i = np.flatnonzero(ok)
            j = other[i]
            good = k[i] == k[j]
            i, j = order[i[good]], order[j[good]]
            for a in range(0, len(i), 100_000):
                x, y = i[a : a + 100_000], j[a : a + 100_000]
                r, w = _common(right[x], right[y], nr[x], nr[y]), _common(left[x], left[y], nl[x], nl[y])
                hit = r + w + gram >= least
                rows.append(x[hit])
                starts.append(pos[x[hit]] - w[hit])
                ends.append(pos[x[hit]] + gram + r[hit])
                full[x[hit & (r == nr[x]) & (w == nl[x])]] = True
    if not rows:
        return *(np.zeros(0, np.int64) for _ in range(3)), full
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(ends), full


def _splits(key: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, nl: np.ndarray, nr: np.ndarray):
    """For each number of words before the first words, so that both sides add up to a side: (rows that have the words,
    in the order of their hash; where runs of equal hashes start; the runs' hashes; whether a run has two documents)."""
    side = left.shape[1]
    after = np.zeros((side + 1, len(key)), np.uint64)
    for j in range(side):
        after[j + 1] = after[j] * _MULT[0] + right[:, j] + np.uint64(1)
    before = key.view(np.uint64).copy()
    for n in range(side + 1):
        at = np.flatnonzero((nl >= n) & (nr >= side - n))
        h = (before[at] ^ (before[at] >> np.uint64(31))) * _MULT[1] + after[side - n][at] * _MULT[2] + np.uint64(n)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        start = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1]) if len(h) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(doc[at], start) != np.maximum.reduceat(doc[at], start) if len(h) else np.zeros(0, bool)
        yield n, at, start, h[start].view(np.int64), several
        if n < side:
            before = before * _MULT[3] + left[:, n] + np.uint64(1)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(doc_id, start_word, end_word): the merged stretches of each document, in words, end exclusive, that lie in
    passages of ``least`` words or more that another document holds too.

    Words are cut at ASCII white space and compared as they are. Null, empty and short texts hold none; rows that
    repeat both id and text are one document; rows with one id, or a null one, and other texts are different ones.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    side = least - gram
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def places(batches):
        for b in text_batches(batches):
            t = strings(b.column("text"))
            first, h = word_hashes(t)
            at, g = anchors(first, h, least, gram)
            own = np.searchsorted(first, at, side="right") - 1
            yield pa.record_batch([pa.array(g.view(np.int64)), pa.array(_doc_keys(b, t)[own]), pa.array((at - first[own]).astype(np.int32))], names=["key", "doc", "pos"])

    found = scratch.save(d.mapInArrow(tidy(places), "key long, doc long, pos int"), "places")
    shared = found.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a <> b")
    deal = F.ceil(F.col("n") / GROUP).cast("int").alias("deal")
    # a key that very many places share is read by several tasks: places are salted by their text, shared keys repeated.
    # Joins here are merges by hint: Spark sizes what a table's files explode or unpack to by the files, too low for a broadcast
    salt = F.pmod(F.xxhash64("doc", "pos"), F.lit(SALTS)).cast("int").alias("salt")
    wanted = scratch.save(shared.select("key", deal), "shared").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    kept = found.select("*", salt).join(wanted.hint("merge"), ["key", "salt"]).groupBy("doc").agg(F.collect_set(F.struct("pos", "deal")).alias("at"))
    kept = scratch.save(kept, "kept")

    def keyed(batches):
        for b in batches:
            yield b.append_column("doc", pa.array(_doc_keys(b, strings(b.column("text"))), pa.int64()))

    met = d.mapInArrow(keyed, "doc_id long, text string, doc long").join(kept.hint("merge"), "doc").dropDuplicates(["doc"])

    def suffixes(batches):
        for b in text_batches(batches, 2_000_000):
            first, h = word_hashes(strings(b.column("text")))
            lists = b.column("at")
            flat, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
            own = np.repeat(np.arange(b.num_rows), per)
            pos = flat.field("pos").to_numpy().astype(np.int64)
            deal = flat.field("deal").to_numpy().astype(np.uint64)
            at, g = anchors(first, h, least, gram)
            want = first[own] + pos
            key = g[np.searchsorted(at, want)]
            padded = np.concatenate([np.zeros(side, np.uint32), h, np.zeros(side + gram, np.uint32)])
            doc = b.column("doc").to_numpy()[own]
            part = np.where(deal > 1, ((doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % deal).astype(np.int64), -1)
            for a in range(0, len(want), 20_000):
                w, o = want[a : a + 20_000], own[a : a + 20_000]
                left = padded[w[:, None] + side - 1 - np.arange(side)]
                right = padded[w[:, None] + side + gram + np.arange(side)]
                nl = np.minimum(w - first[o], side).astype(np.int32)
                nr = np.minimum(first[o + 1] - w - gram, side).astype(np.int32)
                ctx = np.concatenate([left, right], axis=1).astype("<u4")
                yield pa.record_batch([pa.array(key[a : a + 20_000].view(np.int64)), pa.array(part[a : a + 20_000].astype(np.int32)), pa.array(doc[a : a + 20_000]), b.column("doc_id").take(pa.array(o)), pa.array(pos[a : a + 20_000].astype(np.int32)), pa.array(nl), pa.array(nr), pa.array([x.tobytes() for x in ctx], pa.binary())], names=["key", "part", "doc", "doc_id", "pos", "nl", "nr", "ctx"])

    sent = met.select("doc_id", "text", "doc", "at").mapInArrow(tidy(suffixes), "key long, part int, doc long, doc_id long, pos int, nl int, nr int, ctx binary")
    dealt = sent.repartition(partitions(spark), "key", "part").sortWithinPartitions("key", "part")

    def compare(batches):
        held, size = [], 0

        def batch(doc, doc_id, s, e, h) -> pa.RecordBatch:
            return pa.record_batch([doc, doc_id, pa.array(s, pa.int32()), pa.array(e, pa.int32()), h], names=["doc", "doc_id", "s", "e", "h"])

        def done(rows: pa.Table):
            col = lambda c: rows.column(c).to_numpy()
            ctx = np.frombuffer(b"".join(rows.column("ctx").to_pylist()), "<u4").reshape(-1, 2 * side)
            left, right = ctx[:, :side], ctx[:, side:]
            key, part, doc, pos, nl, nr = np.ascontiguousarray(col("key")), col("part").astype(np.int64), np.ascontiguousarray(col("doc")), col("pos").astype(np.int64), col("nl"), col("nr")
            group = np.ascontiguousarray(key.view(np.uint64) ^ (part.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)
            i, s, e, full = _passages(group, doc, pos, left, right, nl, nr, least, gram)
            ids = rows.column("doc_id").combine_chunks()
            of = lambda x: (pa.array(doc[x]), ids.take(pa.array(x)))
            yield batch(*of(i), s, e, pa.nulls(len(i), pa.int64()))
            begin = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1])
            size = np.diff(np.concatenate([begin, [len(key)]]))
            wanted = (size > 2) & (np.add.reduceat((~full).astype(np.int64), begin) > 0) | (part[begin] >= 0)
            pick = np.flatnonzero(np.repeat(wanted, size))
            if not len(pick):
                return
            hot, p_pos = part[pick] >= 0, pos[pick]
            hits = np.zeros((side + 3, len(pick)), np.int8)
            for n, at, start, h, several in _splits(key[pick], doc[pick], left[pick], right[pick], nl[pick], nr[pick]):
                each = np.repeat(several, np.diff(np.concatenate([start, [len(at)]])))
                hits[n + 1, at[each]] = 1
                dealt_run = hot[at[start]]
                seen = h[dealt_run & several]
                if len(seen):
                    yield batch(pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.int64()), np.zeros(len(seen)), np.zeros(len(seen)), pa.array(seen))
                alone = np.flatnonzero(~each & hot[at])
                if len(alone):
                    x = at[alone]
                    yield batch(*of(pick[x]), p_pos[x] - n, p_pos[x] + gram + side - n, pa.array(np.repeat(h, np.diff(np.concatenate([start, [len(at)]])))[alone]))
            turn = np.diff(hits, axis=0).T
            x, low = np.nonzero(turn == 1)
            high = np.nonzero(turn == -1)[1] - 1  # rows and runs come in the same order
            yield batch(*of(pick[x]), p_pos[x] - high, p_pos[x] + gram + side - low, pa.nulls(len(x), pa.int64()))

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size >= 100_000:  # whole groups only; the last, perhaps cut, waits
                rows = pa.Table.from_batches(held).combine_chunks()
                k, p = rows.column("key").to_numpy(), rows.column("part").to_numpy()
                new = np.flatnonzero((k[1:] != k[:-1]) | (p[1:] != p[:-1])) + 1
                if len(new):
                    yield from done(rows.slice(0, int(new[-1])))
                    held = rows.slice(int(new[-1])).to_batches()
                    size = sum(x.num_rows for x in held)
        if size:
            yield from done(pa.Table.from_batches(held).combine_chunks())

    proved = scratch.save(dealt.mapInArrow(tidy(compare), "doc long, doc_id long, s int, e int, h long"), "proved")
    spread = proved.where("h is not null")
    met_elsewhere = spread.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.bool_or(F.col("doc").isNull()).alias("seen")).where("seen or a <> b").select("h")
    late = spread.where("doc is not null").join(met_elsewhere.hint("merge"), "h", "left_semi").select("doc", "doc_id", "s", "e")
    spans = proved.where("h is null").select("doc", "doc_id", "s", "e")
    merged = spans.unionByName(late).groupBy("doc", "doc_id").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))
    grow = F.expr(
        "aggregate(spans, cast(array() as array<struct<s:int,e:int>>), (acc, x) -> "
        "if(size(acc) > 0 and element_at(acc, -1).e >= x.s, "
        "concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).s as s, greatest(element_at(acc, -1).e, x.e) as e))), "
        "concat(acc, array(x))))"
    )
    return merged.select("doc_id", F.explode(grow).alias("x")).select("doc_id", F.col("x.s").alias("start_word"), F.col("x.e").alias("end_word"))
