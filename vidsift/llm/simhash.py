"""Near copies by SimHash, found by meet-in-the-middle ball hashing.

Every fingerprint emits the variants within half the radius and fingerprints meet on equal variants. For a radius
of three bits the ball is kept to the variants that a pair needs to meet once:

* pairs one or three bits apart differ in the parity of their bit counts, pairs two bits apart agree in it;
* of three differing bits two lie in the same 32-bit half. The odd fingerprint flips those two, the even one the third;
* one flipped bit each, or one and none, serves distances one and two.

So all emit themselves and 64 single flips, odd ones also the 992 flips of two bits in one half. A bucket holds at
most one ball of different fingerprints whatever the data, because copies of a fingerprint are merged first. In a
bucket all members are within three bits of any member that flipped at most one bit, so a star to the least such
member links the bucket; a bucket of two-bit flips only needs no link. Copies are never expanded into pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import Scratch, components, fresh, partitions, release, strings, text_batches

MASKS = np.array([0] + [1 << i for i in range(64)] + [(1 << i) | (1 << j) for half in (0, 32) for i in range(half, half + 32) for j in range(i + 1, half + 32)], dtype=np.uint64)
SINGLE = 65
HOME = 20
SALTS = 16
VARIANTS_A_BLOCK = 3_000_000
VARIANTS_AT_ONCE = 1_000_000


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text: no word gives 0, fewer words than a shingle count as one shingle."""
    w = text.lower().split()
    n, digest = len(w), xxhash.xxh64_intdigest
    if not n:
        return 0
    joined = b" ".join(w)
    if n <= shingle:
        return digest(joined, seed)
    lens = np.fromiter(map(len, w), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: n - shingle + 1]
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(column: pa.ChunkedArray | pa.Array, shingle: int) -> np.ndarray:
    raw = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()
    return np.array([fingerprint(x, shingle) for x in raw], dtype=np.uint64).view(np.int64)


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """All columns of docs and a long column ``out`` with the fingerprint of the whole text."""

    def add(batches):
        for b in text_batches(batches, text=text):
            yield b.append_column(out, pa.array(_fingerprints(b.column(text), shingle), pa.int64()))

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(out, LongType())]))


def links(scratch: Scratch, fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (t, a, b) between different fingerprints of one table t whose transitive closure is that of all pairs of
    the table at most ``max_bits`` (0 to 3) bits apart. fps has t (int) and fp (long).

    Up to two bits, single flips meet, and all members of a bucket are that near. Each member links to the least
    near one of its bucket and to the one before it. Variants are dealt out by their lowest HOME bits then, so all flips
    of higher bits go with the fingerprint itself: it is sent HOME + 1 times, and the task that gets it flips the rest.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3")
    wide = len(MASKS) if max_bits == 3 else SINGLE
    sent_with = SINGLE if wide > SINGLE else HOME + 1  # of the masks 0 to SINGLE - 1
    dealt_by = np.uint64(2**64 - 1 if wide > SINGLE else 2**HOME - 1)
    fps = scratch.save(fps.select(F.col("t").cast("int").alias("t"), "fp").where("fp is not null").distinct(), "fps")
    n = fps.count()
    parts = max(16, -(-n * (wide + SINGLE) // 2 // VARIANTS_A_BLOCK))
    spread = np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64)

    def emit(batches):
        schema = pa.schema([("pid", pa.int32()), ("fps", pa.binary()), ("masks", pa.binary()), ("ts", pa.binary())])
        for b in batches:
            every, tables = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), b.column("t").to_numpy(zero_copy_only=False).astype(np.uint8)
            step = 1024 if wide > SINGLE else 8192
            for at in range(0, len(every), step):
                got, ts = every[at : at + step], tables[at : at + step]
                odd = (np.bitwise_count(got) & 1 == 1) & (wide > SINGLE)
                f = np.concatenate([np.repeat(got[~odd], sent_with), np.repeat(got[odd], wide)])
                t = np.concatenate([np.repeat(ts[~odd], sent_with), np.repeat(ts[odd], wide)])
                m = np.concatenate([np.tile(np.arange(sent_with, dtype=np.uint16), int((~odd).sum())), np.tile(np.arange(wide, dtype=np.uint16), int(odd.sum()))])
                v = ((f ^ MASKS[m]) & dealt_by ^ spread[t]) * np.uint64(0x9E3779B97F4A7C15)
                pid = ((v >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint32)
                order = np.argsort(pid.astype(np.uint16) if parts < 65536 else pid, kind="stable")
                f, m, t, pid = f[order], m[order], t[order], pid[order]
                cut = np.concatenate([[0], np.flatnonzero(np.diff(pid)) + 1, [len(pid)]]) if len(pid) else [0]
                spans = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.record_batch([pa.array([int(pid[x]) for x, _ in spans], pa.int32()), *(pa.array([c[x:y].tobytes() for x, y in spans], pa.binary()) for c in (f, m, t))], schema=schema)

    def meet(batches):
        held: list = []
        for b in batches:
            for pid, *blobs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0][0] != pid:
                    yield from block(held)
                    held = []
                held.append((pid, *blobs))
        if held:
            yield from block(held)
        del held
        release()

    def unfolded(f, m, t):
        own, more = m == 0, np.arange(sent_with, SINGLE, dtype=np.uint16)
        return np.append(f, np.repeat(f[own], len(more))), np.append(m, np.tile(more, int(own.sum()))), np.append(t, np.repeat(t[own], len(more)))

    def block(got):
        all_f, all_m, all_t = (np.frombuffer(b"".join(x[i] for x in got), kind) for i, kind in ((1, np.uint64), (2, np.uint16), (3, np.uint8)))
        got.clear()
        variants = len(all_f) + int((all_m == 0).sum()) * (SINGLE - sent_with)
        slices = min(256, max(1, -(-variants // VARIANTS_AT_ONCE)))
        for part in range(slices):
            picked = []
            for at in range(0, len(all_f), 65536):
                f, m, t = unfolded(*(x[at : at + 65536] for x in (all_f, all_m, all_t)))
                pick = np.flatnonzero(((f ^ MASKS[m]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(56)).astype(np.uint8) % slices == part)
                picked.append((f[pick], m[pick], t[pick]))
            f, m, t = map(np.concatenate, zip(*picked, strict=True))
            if len(f):
                yield in_buckets(f, m, t)

    def in_buckets(f, m, t):
        v = f ^ MASKS[m]
        order = np.lexsort((f, v ^ spread[t], t))
        v, f, m, t = v[order], f[order], m[order], t[order]
        start = np.concatenate([[0], np.flatnonzero((v[1:] != v[:-1]) | (t[1:] != t[:-1])) + 1])
        size = np.diff(np.concatenate([start, [len(v)]]))
        far = m >= SINGLE
        anchor = np.minimum.reduceat(np.where(far, np.uint64(2**64 - 1), f), start)
        near = np.add.reduceat((~far).astype(np.int64), start) > 0
        use = np.repeat((size > 1) & near, size)
        head = np.zeros(len(v), bool)
        head[start] = True
        chain = np.flatnonzero(use & ~head)
        a = np.concatenate([np.repeat(anchor, size)[use], f[chain - 1]])
        x, tt = np.concatenate([f[use], f[chain]]), np.concatenate([t[use], t[chain]])
        good = (a != x) & (np.bitwise_count(a ^ x) <= max_bits)
        pairs = np.unique(np.stack([tt[good].astype(np.uint64), a[good], x[good]], axis=1), axis=0)
        return pa.record_batch([pa.array(pairs[:, 0].astype(np.int32), pa.int32())] + [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64), pa.int64()) for i in (1, 2)], names=["t", "a", "b"])

    sent = fps.repartition(max(partitions(fps.sparkSession), min(parts, 4096))).mapInArrow(emit, "pid int, fps binary, masks binary, ts binary")
    return sent.repartition(parts, "pid").sortWithinPartitions("pid").mapInArrow(meet, "t int, a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links).

    Null and empty texts have fingerprint zero and are linked like any other; rows with a null doc_id get a row and
    count in no minimum (a component of such rows only has a null component_id); repeated rows each get a row; an
    empty table gives none. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    work = scratch.inner()
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    fps = scratch.save(with_fingerprint(d, shingle=shingle).select("doc_id", "fp"), "documents")
    known = work.save(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "known")
    roots = components(work, links(work, known.withColumn("t", F.lit(0)), max_bits).drop("t")).select(F.col("v").alias("fp"), "root")
    least = known.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    of_root = least.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = scratch.save(least.join(of_root, "root").select("fp", "component_id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "classes")
    work.drop()
    # a fingerprint that very many documents share is read by several tasks
    salted = fps.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(of_fp, ["fp", "salt"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


TABLES = 8
LANES = 128
LIKELY = 70
SAMPLE = 8_000
COMMON = 3
COMMON_AT_MOST = 100_000
SMALL = 32
LANE_ROWS = 8192
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = (np.arange(256) + 1 + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90))).astype(np.uint64)
_LOWER[_BLANK] = 0


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's first word number (and the end), and a 64-bit hash of each word with A-Z lower-cased.

    texts come from strings(). Words are runs of bytes between ASCII white space; a word's hash is a polynomial in its
    bytes, mixed, so a batch takes a few passes over its bytes whatever the number of words.
    """
    at = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: at[-1]]
    full = ~_BLANK[data]
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    edge = at[:-1][at[:-1] < at[1:]]
    begins[edge] = full[edge]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.zeros(len(at), np.int64), np.zeros(0, np.uint64)
    run = np.diff(np.append(start, len(data)))
    power = np.multiply.accumulate(np.full(int(run.max()), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(start[0], len(data)) - np.repeat(start, run)
    h = np.add.reduceat(_LOWER[data[start[0] :]] * power[place], start - start[0])
    return np.searchsorted(start, at), _mixed(h)


def _shingles(first: np.ndarray, h: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The different shingle hashes of each text, ascending; a text of fewer words is one shingle."""
    g = np.zeros(len(h), np.uint64)
    wide = np.concatenate([h, np.zeros(shingle, np.uint64)])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(h))
    for j in range(shingle):
        x = _mixed_once((wide[j : j + len(h)] + np.uint64(1)) * _MULT[j % len(_MULT)])
        if j:
            x[left <= j] = 0
        g += x
    g = _mixed(g)
    ends = np.maximum(np.minimum(first[:-1] + 1, first[1:]), first[1:] - shingle + 1)
    out = []
    for a, b in zip(first[:-1].tolist(), ends.tolist(), strict=True):
        x = np.sort(g[a:b])
        out.append(x[np.append(True, x[1:] != x[:-1])] if len(x) else x)
    return out


def shingle_sets(texts: pa.Array, shingle: int = 5) -> list[np.ndarray]:
    """Of each text the hashes of all its different word shingles, ascending."""
    first, h = hashed_words(texts)
    return _shingles(first, h, shingle)


_LANE_MULT = (np.random.default_rng(3).integers(0, 2**63, LANES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def sketches(sets: list[np.ndarray], lanes: int = LANES) -> list[bytes]:
    """Of each shingle set a byte for each of ``lanes`` minima; two sets agree in about as many as they are similar."""
    size = np.array([len(x) for x in sets], np.int64)
    full = np.flatnonzero(size)
    out = np.zeros((len(sets), lanes), np.uint8)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        begin = np.cumsum(size[full]) - size[full]
        for i in range(lanes):
            out[full, i] = np.minimum.reduceat(_mixed_once(flat * _LANE_MULT[i]), begin) & np.uint64(255)
    return [x.tobytes() for x in out]


def _mixed_once(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


PARITY = 2048
NARROW = 512


def parities(sets: list[np.ndarray], bits: int = PARITY) -> list[bytes]:
    """Of each shingle set a bit for each of ``bits`` cells: whether the set has an odd number of shingles there.

    Shingles that two sets share cancel out, so these bits differ in at most as many places as the sets do.
    """
    out = []
    for a in range(0, len(sets), 256):
        some = sets[a : a + 256]
        cell = (_mixed(np.concatenate(some)) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)
        cell += np.repeat(np.arange(len(some)), [len(x) for x in some]) * bits
        odd = np.bincount(cell, minlength=len(some) * bits).astype(np.uint8) & 1
        out += [x.tobytes() for x in np.packbits(odd.reshape(len(some), bits), axis=1, bitorder="little")]
    return out


def whole_sketches(sets: list[np.ndarray]) -> list[bytes]:
    """Of each shingle set its narrow parities, minima and parities, one after the other (Sketches)."""
    return [b"".join(x) for x in zip(parities(sets, NARROW), sketches(sets), parities(sets), strict=True)]


class Sketches:
    """Minima and parities of many sets side by side, to tell which of them can be alike.

    Parities rule out for certain: sets of similarity s differ in at most (1 - s) / (1 + s) of the sum of their sizes.
    Parities of NARROW cells, which keep that bound, are looked at first. They say little of sets far larger than their
    cells; minima do: a pair of 0.8 agrees in fewer than LIKELY of the LANES bytes with a chance below 1e-8. Rows are
    narrow parities, minima and PARITY parities, or narrow parities alone.
    """

    def __init__(self, rows: list[bytes], n: np.ndarray, similarity: float):
        both = np.frombuffer(b"".join(rows), np.uint8).reshape(len(n), -1)
        self.n, cut = n, (NARROW // 8, NARROW // 8 + LANES)
        self.parities = [np.ascontiguousarray(x).view(np.uint64) for x in (both[:, : cut[0]], both[:, cut[1] :]) if x.size]
        self.minima = both[:, cut[0] : cut[1]]
        self.similarity, self.least, self.apart = similarity, LIKELY * similarity / 0.8, (1 - similarity) / (1 + similarity)

    def alike(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether sets x[i] and y[i], by place, can be alike. x and y are arrays of places; x may be a single place."""
        x = np.broadcast_to(x, y.shape)
        out = np.zeros(len(y), bool)
        left = np.flatnonzero(np.minimum(self.n[x], self.n[y]) >= self.similarity * np.maximum(self.n[x], self.n[y]) - 1e-9)
        for parity in self.parities:
            differ = np.bitwise_count(parity[x[left]] ^ parity[y[left]]).sum(axis=1, dtype=np.int64)
            left = left[differ <= self.apart * (self.n[x[left]] + self.n[y[left]]) + 1e-9]
        if self.minima.size:
            left = left[(self.minima[x[left]] == self.minima[y[left]]).sum(axis=1) >= self.least]
        out[left] = True
        return out


def word_fingerprints(texts: pa.Array, tables: int = TABLES, shingle: int = 5) -> tuple[np.ndarray, list[np.ndarray], list[bytes]]:
    """Of each text: ``tables`` independent SimHashes of its words, its shingle set, a key of its words.

    Words (ASCII lower case) vote with the bit length of their count, so common words don't drown the others; a text of
    fewer words than a shingle is one shingle.
    """
    first, h = hashed_words(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((h, doc))
    word, owner = h[order], doc[order]
    new = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (owner[1:] != owner[:-1]))) if len(word) else np.zeros(0, np.int64)
    weight = np.frexp(np.diff(np.append(new, len(word))))[1]  # bit length
    votes, owner = np.repeat(word[new], weight), np.repeat(owner[new], weight)
    ones, total = np.zeros((n, 64 * tables), np.int32), np.bincount(owner, minlength=n)
    for a in range(0, len(votes), 8192):
        v, o = votes[a : a + 8192], owner[a : a + 8192]
        lanes = np.concatenate([_LANES[_mixed(v + _MULT[:1] * np.uint64(t + 1)).view(np.uint8).reshape(-1, 8)] for t in range(tables)], axis=1)
        begin = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        within = np.arange(len(v)) - np.repeat(begin, np.diff(np.append(begin, len(v))))
        cut = np.flatnonzero(within % 255 == 0)  # a lane counts to 255
        part = np.ascontiguousarray(np.add.reduceat(lanes, cut, axis=0)).view(np.uint8).reshape(len(cut), -1)
        ones[o[begin]] += np.add.reduceat(part, np.searchsorted(cut, begin), axis=0, dtype=np.int32)
    bits = np.packbits(ones * 2 > total[:, None], axis=1, bitorder="little").view("<u8").reshape(n, tables)
    sets = _shingles(first, h, shingle)
    low = pc.ascii_lower(texts)
    keys = [xxhash.xxh3_128_digest(b" ".join(raw.split())) for raw in low.cast(pa.large_binary()).to_pylist()]
    return bits, sets, keys


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Similarity of two sets given as ascending arrays; two empty sets are alike."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def likely(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes less those whose sizes or sketches are too far apart (Sketches). nodes: node, n, sketch."""
    of = lambda side: nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
    met = pairs.join(of("a"), "a").where("n_a > 0").join(of("b"), "b").where(F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9)

    def near(batches):
        for b in batches:
            if m := b.num_rows:
                both = Sketches([*b.column("s_a").to_pylist(), *b.column("s_b").to_pylist()], np.concatenate([b.column(c).to_numpy() for c in ("n_a", "n_b")]), similarity)
                keep = pa.array(both.alike(np.arange(m), np.arange(m, 2 * m)))
                yield pa.record_batch([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    return met.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(near, "a long, b long")


def verified(texts: DataFrame, pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Of different pairs (a, b) of uids those whose whole shingle sets have the Jaccard similarity. texts: uid, text."""
    n = partitions(texts.sparkSession)
    both = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("uid"))
    dealt = texts.join(both, "uid").select("a", "b", "text").repartition(n, "a", "b").sortWithinPartitions("a", "b")

    def check(batches):
        held = None
        for batch in text_batches(batches):
            sets, found = shingle_sets(strings(batch.column("text")), shingle), []
            for a, b, x in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), sets, strict=True):
                if held is None or held[:2] != (a, b):
                    held = (a, b, x)
                    continue
                if jaccard(held[2], x) >= similarity:
                    found.append((a, b))
                held = None
            yield pa.record_batch([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        release()

    return dealt.mapInArrow(check, "a long, b long")


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (uid and others) of the nodes (node) that have any shingle (n)."""
    return rows.join(nodes.where("n > 0").select(F.col("node").alias("uid")), "uid", "left_semi")


def _common(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a bounded sample of texts repeats, ascending, and their counts. They only set an order."""
    share = min(1.0, SAMPLE / max(1, texts.count()))

    def rows(batches):
        for b in text_batches(batches):
            yield pa.record_batch([pa.array(np.concatenate(shingle_sets(strings(b.column("text")), shingle)).view(np.int64))], names=["h"])
        release()

    some = texts.where(F.xxhash64("uid") <= int(-(2**63) + share * (2**64 - 1))) if share < 1 else texts
    counts = some.mapInArrow(rows, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    got = counts.orderBy(F.col("n").desc(), "h").limit(COMMON_AT_MOST).collect()
    h, n = np.array([r.h for r in got], np.int64).view(np.uint64), np.array([r.n for r in got], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _runs(batches, key: str):
    """Columns of batches sorted by a key, cut so that no run of equal keys is split: lists of arrays, the key's first."""
    held: list[list[np.ndarray]] = []

    def whole():
        return [np.concatenate(c) for c in zip(*held, strict=True)]

    for b in batches:
        if not b.num_rows:
            continue
        now = [b.column(key).to_numpy(zero_copy_only=False), *(b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(b.schema.names) if c != key)]
        last = int(np.searchsorted(now[0], now[0][-1]))  # where the run begins that may go on
        if last or (held and held[-1][0][-1] != now[0][0]):
            held.append([c[:last] for c in now])
            yield whole()
            held = []
        held.append([c[last:] for c in now])
    if held:
        yield whole()


def _spans(keys: np.ndarray, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of equal keys that hold ``least`` rows or more."""
    begin = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    end = np.append(begin[1:], len(keys))
    many = end - begin >= least
    return begin[many], end[many]


def prefix_buckets(work: Scratch, texts: DataFrame, shingle: int, similarity: float, nodes: DataFrame | None = None) -> DataFrame:
    """(lane, bucket, node, n): texts that share a shingle of their prefixes, n being the size of a text's shingle set.

    Of two sets of that similarity each holds a common shingle among its first n - ceil(similarity n) + 1 in any order
    of all shingles (prefix filter), so every such pair shares a bucket. Rare shingles come first. Equal buckets are one.
    Buckets of the same least node share a lane, as they hold much the same texts and would propose the same pairs; a
    node of more than LANE_ROWS rows in its buckets has several lanes, of about LANE_ROWS rows each. With ``nodes`` (node)
    only those of the texts count; prefixes are cut before that join, so it shuffles no texts.
    """
    common, often = _common(texts if nodes is None else _of_nodes(texts, nodes), shingle)
    parts = partitions(texts.sparkSession)

    def rows(batches):
        for b in text_batches(batches):
            sets = shingle_sets(strings(b.column("text")), shingle)
            size = np.array([len(x) for x in sets], np.int64)
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            count = np.zeros(len(flat), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
                count = np.where(common[at] == flat, often[at], 0)
            order = np.lexsort((flat, count, owner)) if count.any() else np.arange(len(flat))
            flat, owner = flat[order], owner[order]
            rank = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            long = np.minimum(size, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(long)), pa.int32()), pa.array(flat[rank < long[owner]].view(np.int64)))
            yield pa.record_batch([b.column("uid"), pa.array(size), lists], names=["uid", "n", "h"])
        release()

    def shared(batches):
        seen: set = set()
        for h, node, n in _runs(batches, "h"):
            digests, lists, sizes = [], [], []
            for x, y in zip(*map(np.ndarray.tolist, _spans(h)), strict=True):
                digest = xxhash.xxh3_128_digest(node[x:y].tobytes())
                if digest not in seen:
                    if len(seen) < 100_000:
                        seen.add(digest)
                    digests.append(digest)
                    lists.append(node[x:y])
                    sizes.append(n[x:y])
            if digests:
                offsets = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in (lists, sizes))], names=["digest", "node", "n"])
        release()

    prefixes = texts.mapInArrow(rows, "uid long, n long, h array<long>")
    prefixes = prefixes if nodes is None else _of_nodes(prefixes, nodes)
    met = prefixes.select(F.explode("h").alias("h"), F.col("uid").alias("node"), "n").repartition(parts, "h").sortWithinPartitions("h", "node")
    lists = work.save(met.mapInArrow(shared, "digest binary, node array<long>, n array<long>").dropDuplicates(["digest"]), "buckets")
    headed = lists.withColumn("head", F.col("node")[0])
    hot = headed.groupBy("head").agg(F.ceil(F.sum(F.size("node")) / LANE_ROWS).alias("lanes")).where("lanes > 1")
    salt = F.when(F.col("lanes").isNotNull(), F.pmod(F.xxhash64("digest"), F.col("lanes"))).otherwise(F.lit(0))
    laned = headed.join(hot, "head", "left").select(F.xxhash64("head", salt).alias("lane"), F.xxhash64("digest").alias("bucket"), F.arrays_zip("node", "n").alias("x"))
    return laned.select("lane", "bucket", F.explode("x").alias("x")).select("lane", "bucket", "x.node", "x.n")


def proposals(first: int, end: int, similarity: float):
    """A function over batches (lane, bucket, node, n, root, sketch), sorted by the first three: pairs (a, b) that hubs propose.

    Members first to end of a bucket, or all of a small one, are its hubs; each proposes the members after it that are
    not in its group and can be alike by size and by sketch. Buckets of a lane say a pair once. A bucket with more hubs
    to come is handed on as (bucket, null).
    """

    def propose(batches):
        for _, bucket, node, n, root, sketch in _runs(batches, "lane"):
            out_a, out_b, left = [], [], []
            for x, y in zip(*map(np.ndarray.tolist, _spans(bucket)), strict=True):
                m = y - x
                if (first and m <= SMALL) or m <= first + 1 or (root[x:y] == root[x]).all():
                    continue
                last = m if m <= SMALL else min(end, m)
                if last < m - 1:
                    left.append(int(bucket[x]))
                held = Sketches(sketch[x:y].tolist(), n[x:y], similarity)
                for i in range(x + first, x + last):
                    fits = (root[i + 1 : y] != root[i]) & (np.minimum(n[i + 1 : y], n[i]) >= similarity * np.maximum(n[i + 1 : y], n[i]) - 1e-9)
                    others = i + 1 + np.flatnonzero(fits)
                    if len(others):
                        others = others[held.alike(np.array(i - x), others - x)]
                    if len(others):
                        out_a.append(np.full(len(others), node[i]))
                        out_b.append(node[others])
            if out_a or left:
                a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (out_a, out_b))
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
                new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
                a, b = np.append(a[new], np.array(left, np.int64)), np.append(b[new], np.zeros(len(left), np.int64))
                full = np.arange(len(a)) < len(a) - len(left)
                yield pa.record_batch([pa.array(a), pa.array(b, mask=~full)], names=["a", "b"])
        release()

    return propose


def settled(work: Scratch, texts: DataFrame, nodes: DataFrame, known: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Roots (v, root) of the groups closed over all pairs of that similarity, given links ``known`` among them.

    Each round the next hubs of a bucket (all members of a small one) meet the members that are not yet in their
    group; hubs grow eightfold. A bucket is done when it is one group or all its possible pairs have been compared.
    Only pairs that can be alike by sketch leave the task: rows carry narrow parities in the first round, whole sketches
    later, when few buckets are left. texts may hold more than the nodes.
    """
    links_ = known
    roots = work.save(components(work, links_), "roots")
    buckets = prefix_buckets(work, texts, shingle, similarity, nodes)
    work.sweep()
    compared, some, done, hubs = None, None, 0, 4
    parts = partitions(texts.sparkSession)
    while True:
        sketch = F.col("sketch") if done else F.substring("sketch", 1, NARROW // 8)
        sketched = buckets.join(nodes.select("node", sketch.alias("sketch")), "node")
        rooted = sketched.join(roots.withColumnRenamed("v", "node"), "node", "left").select("lane", "bucket", "node", "n", F.coalesce("root", "node").alias("root"), "sketch")
        dealt = rooted.repartition(parts, "lane").sortWithinPartitions("lane", "bucket", "node")
        said = work.save(dealt.mapInArrow(proposals(done, done + hubs, similarity), "a long, b long").distinct(), "proposed")
        work.sweep()
        pairs = said.where("b is not null")
        pairs = pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")
        near = work.save(likely(pairs, nodes, similarity), "likely")
        compared = pairs if compared is None else compared.unionByName(pairs)
        more = said.where("b is null").select(F.col("a").alias("bucket"))
        done, hubs = done + hubs, hubs * 8
        going = not more.isEmpty()
        if not near.isEmpty():
            if some is None and going:
                # later rounds read the texts of the buckets that are still open, not all
                some = work.save(texts.join(buckets.join(more, "bucket", "left_semi").select(F.col("node").alias("uid")).distinct(), "uid", "left_semi"), "some")
                work.sweep()
                use = texts
            else:
                use = texts if some is None else some
            links_ = links_.unionByName(work.save(verified(use, near, shingle, similarity), "true"))
            roots = work.save(components(work, links_), "roots")
            work.sweep()
        if not going:
            return roots
        buckets = work.save(buckets.join(more, "bucket", "left_semi"), "open")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, tables: int = TABLES, max_bits: int = 2) -> DataFrame:
    """The rows of docs, with their columns, that lead their group of near copies: its least doc_id (null last), one row.

    Texts of the same words are one. Others are near copies if the Jaccard similarity of their whole sets of word
    shingles is ``similarity`` or more, groups being closed over all such pairs. Pairs whose word SimHashes are within
    ``max_bits`` in one of the tables are compared first, over the least member of a bucket; that joins large groups at
    little cost. The prefix filter then brings every other possible pair, so neither the tables nor the bits decide the
    result. Null and empty texts are one group; of repeated rows one stays. Columns of docs may have any names.
    """
    scratch = Scratch(docs.sparkSession)
    work = scratch.inner()
    (uid,) = fresh(docs.columns, "__uid")
    tagged = scratch.save(docs.withColumn(uid, F.monotonically_increasing_id()), "tagged")

    def add(batches):
        for b in text_batches(batches, 1_000_000):
            bits, sets, keys = word_fingerprints(strings(b.column("text")), tables, shingle)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * tables, pa.int32()), pa.array(bits.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("uid"), lists, pa.array([len(x) for x in sets], pa.int64()), pa.array(whole_sketches(sets), pa.binary()), pa.array(keys, pa.binary())], names=["uid", "fps", "n", "sketch", "key"])
        release()

    texts = tagged.select(F.col(uid).alias("uid"), F.col(f"`{text}`").alias("text"))
    marks_ = scratch.inner()
    marked = marks_.save(texts.mapInArrow(add, StructType([StructField("uid", LongType()), StructField("fps", ArrayType(LongType())), StructField("n", LongType()), StructField("sketch", BinaryType()), StructField("key", BinaryType())])), "marked")
    ids = marked.select("uid", "key").join(tagged.select(F.col(uid).alias("uid"), F.col(f"`{doc_id}`").alias("id")), "uid")
    ids = work.save(ids, "ids")
    lead = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("uid").alias("u")))
    firsts = ids.groupBy("key").agg(lead.alias("lead")).withColumn("node", F.col("lead.u"))
    nodes = work.save(firsts.join(marked.select(F.col("uid").alias("node"), "fps", "n", "sketch"), "node"), "nodes")
    marks_.drop()
    marks = nodes.where("n > 0").select("node", F.posexplode("fps").alias("t", "fp"))
    heads = work.save(marks.groupBy("t", "fp").agg(F.min("node").alias("head")), "heads")
    same = marks.join(heads, ["t", "fp"]).where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    of = lambda side, out: heads.select("t", F.col("fp").alias(side), F.col("head").alias(out))
    near = links(work, heads, max_bits).join(of("a", "x"), ["t", "a"]).join(of("b", "y"), ["t", "b"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    sized = nodes.select("node", "n", "sketch")
    pairs = work.save(likely(same.unionByName(near).where("a <> b").distinct(), sized, similarity), "candidates")
    work.sweep()
    true = work.save(verified(texts, pairs, shingle, similarity), "true")
    work.sweep()
    roots = settled(work, texts, sized, true, shingle, similarity)
    rooted = nodes.join(roots.withColumnRenamed("v", "node"), "node", "left").select("key", "lead", F.coalesce("root", "node").alias("root"))
    leads = rooted.groupBy("root").agg(F.min("lead")["u"].alias("keep"))
    of_key = rooted.join(leads, "root").select("key", "keep")
    gone = scratch.save(ids.join(of_key, "key").where("uid <> keep").select(F.col("uid").alias(uid)), "gone")
    work.drop()
    return tagged.join(gone, uid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
