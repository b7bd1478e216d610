"""Exact top-k inner products over norm-sorted vectors.

Vectors are quantised to integers and written in descending length, packed into rows of bounded size. Queries are
packed likewise; each such block starts from the exact k-th scores among the longest vectors, and meets only the packs
whose longest vector can reach one of them (|q||x|, a condition of the join). In a pair of packs, vectors are turned
into the axes of the corpus' second moments (its SVD), and the leading coordinates' product plus |q rest||x rest|
(Cauchy-Schwarz) drops pairs before their exact integer product is taken. Bounds only drop pairs that cannot enter the
result, so the result is exact. All blocks are rows of one plan; no query comes to the driver.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, partitions, sums

SCALE = 256
BLOCK = 4096
PACK = 512
PACK_BYTES = 4_000_000
HELD = 4
SEEDS = 2048
LARGEST = 2**24
HUGE = float(np.finfo(np.float64).max)
MOST = 2**63 - 1  # scores beyond 64 bits end here


def _vectors(raw: list, dim: int) -> np.ndarray:
    """The packed vectors of one length; integers too large for 32 bits come as whole doubles."""
    if any(len(r) != 4 * dim for r in raw):
        return np.stack([np.frombuffer(r, "<i4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in raw])
    return np.frombuffer(b"".join(raw), "<i4").reshape(-1, dim)


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, dim, v, norm): floor(256 x) of each component as packed 32-bit integers, and the length.

    Rows with a null id, a null vector or a null or non-finite component take no part; an empty vector does, with the
    others of its length. A vector with a component of 65536 or more is packed as whole doubles, which hold its integers
    exactly, up to the largest double, which stands for what would be beyond it.
    """
    d = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).where("vec_id is not null and e is not null")

    def rows(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("e")
            n = np.diff(lists.offsets.to_numpy())
            given = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            bad = ~np.isfinite(given)
            with np.errstate(over="ignore"):
                flat = np.clip(np.floor(np.where(bad, 0, given) * SCALE), -HUGE, HUGE)
            starts = np.cumsum(n) - n
            off = np.append(starts, n.sum())
            ok, wide = sums(bad, off) == 0, sums(np.abs(flat) >= LARGEST, off) > 0
            size = np.zeros(len(n))
            full = n > 0
            size[full] = np.maximum.reduceat(np.abs(flat), starts[full]) if full.any() else 0
            unit = flat / np.maximum(np.repeat(size, n), 1)  # lengths without overflow
            with np.errstate(over="ignore"):
                norm = np.minimum(np.maximum(size, 1) * np.sqrt(sums(unit**2, off)), HUGE)
            keep = np.flatnonzero(ok)
            yield pa.record_batch([b.column("vec_id").take(pa.array(keep)), pa.array(n[keep], pa.int32()), pa.array([flat[starts[i] : starts[i] + n[i]].astype("<f8" if wide[i] else "<i4").tobytes() for i in keep], pa.binary()), pa.array(norm[keep])], names=["vec_id", "dim", "v", "norm"])

    return d.mapInArrow(rows, "vec_id long, dim int, v binary, norm double")


def axes(data: DataFrame, dim: int) -> np.ndarray:
    """Orthonormal columns, by descending second moment over all vectors."""

    def moments(batches):
        from pyspark import TaskContext

        m = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                x = _vectors(b.column("v").to_pylist(), dim).astype(np.float64)
                x = x[np.abs(x).max(axis=1) < 1e100]  # the axes only order the work; squares of longer ones overflow
                m += x.T @ x
        yield pa.record_batch([pa.array([TaskContext.get().partitionId() % 32], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["k", "m"])

    def added(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            for x in b.column("m").to_pylist():
                total += np.frombuffer(x).reshape(dim, dim)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["m"])

    got = data.select("v").mapInArrow(moments, "k int, m binary").repartition(32, "k").mapInArrow(added, "m binary").collect()
    total = reduce(np.add, (np.frombuffer(r.m).reshape(dim, dim) for r in got), np.zeros((dim, dim)))
    return np.linalg.eigh(total)[1][:, ::-1].copy()


class Search:
    """Holds the k best candidates of a block of queries while vectors pass by in descending length."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, rotation: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.q, self.k, self.dim = ids, q.astype(np.float64), k, q.shape[1]
        self.head = max(1, self.dim // 4)
        self.turn = rotation
        with np.errstate(over="ignore", invalid="ignore"):
            self.norm = np.minimum(np.sqrt((self.q**2).sum(axis=1)), HUGE)
            turned = self.q @ rotation
            self.lead, self.rest = turned[:, : self.head], np.sqrt(np.maximum((turned[:, self.head :] ** 2).sum(axis=1), 0))
        self.largest = np.abs(self.q).max(initial=0)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.copy()
        self.best = np.zeros((0, 3), np.int64)  # query number, -score, vec_id

    def add(self, vec_ids: np.ndarray, x: np.ndarray, norms: np.ndarray) -> bool:
        """False when no later, shorter vector can matter."""
        with np.errstate(over="ignore", invalid="ignore"):
            slack = 1e-9 * self.norm * norms.max(initial=0) + 1e-6
            open_q = np.flatnonzero(self.norm * norms.max(initial=0) + slack >= self.floor)
            if not len(open_q):
                return False
            xf = x.astype(np.float64)
            turned = xf @ self.turn
            rest = np.sqrt(np.maximum((turned[:, self.head :] ** 2).sum(axis=1), 0))
            bound = self.lead[open_q] @ turned[:, : self.head].T + np.outer(self.rest[open_q], rest)
            bound[~np.isfinite(bound)] = np.inf  # overflow says nothing
        qi, xi = np.nonzero((bound + slack[open_q, None] >= self.floor[open_q, None]) & (self.ids[open_q][:, None] != vec_ids[None, :]))
        if len(qi):
            qn = open_q[qi]
            if self.largest * np.abs(xf).max() * self.dim < 2**52:
                used, inv = np.unique(qi, return_inverse=True)
                score = (self.q[open_q[used]] @ xf.T)[inv, xi].astype(np.int64)
            else:
                exact = (sum(int(a) * int(b) for a, b in zip(self.q[i], x[j], strict=True)) for i, j in zip(qn, xi, strict=True))
                score = np.array([max(-MOST, min(MOST, e)) for e in exact], np.int64)
            ok = score >= self.floor[qn]
            self.merge(np.stack([qn[ok], -score[ok], vec_ids[xi[ok]]], axis=1))
        return True

    def merge(self, rows: np.ndarray) -> None:
        every = np.concatenate([self.best, rows])
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        start = np.searchsorted(every[:, 0], every[:, 0], side="left")
        rank = np.arange(len(every)) - start
        self.best = every[rank < self.k]
        last = every[rank == self.k - 1]
        self.floor[last[:, 0]] = np.maximum(self.floor[last[:, 0]], -last[:, 1])


def _pieces(batches, dim: int, size: int):
    """Runs of at most ``size`` rows and about PACK_BYTES: ids, vectors, lengths."""
    size = max(1, min(size, PACK_BYTES // (8 * dim)))
    held: list[pa.RecordBatch] = []
    for b in batches:
        held += [b] if b.num_rows else []
        while sum(x.num_rows for x in held) >= size:
            t = pa.Table.from_batches(held)
            yield _arrays(t.slice(0, size), dim)
            held = t.slice(size).to_batches()
    if held:
        yield _arrays(pa.Table.from_batches(held), dim)


def _arrays(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return t.column("vec_id").to_numpy(), _vectors(t.column("v").to_pylist(), dim), t.column("norm").to_numpy()


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    """A pack of vectors; as in _vectors, one with a large integer is all doubles, and its bytes begin with an 8."""
    return np.frombuffer(raw, "<f8" if raw[0] == 8 else "<i4", offset=8).reshape(rows, -1)


def _bytes(x: np.ndarray) -> bytes:
    return bytes([x.itemsize] + [0] * 7) + np.ascontiguousarray(x).tobytes()


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", block: int = BLOCK, pack: int = PACK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, all if there are fewer.

    Queries are the rows whose id is divisible by ``every``; rows with a query's id are its own and no candidates of
    it; of rows that repeat a query's id the least vector asks. Other repeated rows each count. Vectors of different
    lengths are not compared; each length is a search of its own, with its own axes. Empty vectors score 0 among
    themselves. Ties go to the smaller vec_id, scores beyond 64 bits count as the greatest or least that 64 bits hold. An
    empty table gives no rows. block and pack bound the queries and the vectors of a pair of packs.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    work = scratch.inner()
    order = [F.col("norm").desc(), F.col("vec_id").asc()]
    raw = work.save(quantised(vectors, vec_id, embedding), "integers")
    data = scratch.save(raw.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order), "by_length")
    work.drop()
    found = [_search(scratch, data.where(F.col("dim") == r.dim), r.dim, k, every, block, pack) if r.dim else _empty(data.where("dim = 0"), k, every) for r in data.select("dim").distinct().orderBy("dim").collect()]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _empty(own: DataFrame, k: int, every: int) -> DataFrame:
    """Empty vectors all score 0 with each other, so a query's best are the least ids but its own: of 2 k rows, k at most
    of one id, k are left."""
    of_id = own.select("vec_id", F.row_number().over(Window.partitionBy("vec_id").orderBy("vec_id")).alias("n")).where(F.col("n") <= k)
    least = [r.vec_id for r in of_id.orderBy("vec_id").limit(2 * k).collect()]
    first = F.slice(F.filter(F.array(*map(F.lit, least)).cast("array<long>"), lambda x: x != F.col("query_id")), 1, k)
    asking = own.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id")).distinct()
    return asking.select("query_id", F.explode(first).alias("vec_id"), F.lit(0).cast("long").alias("score"))


def _search(scratch: Scratch, own: DataFrame, dim: int, k: int, every: int, block: int, pack: int) -> DataFrame:
    turn = axes(own, dim)
    n = own.count()
    least = own.agg(F.percentile_approx("norm", 1 - SEEDS / n, 10_000)).first()[0] if n > SEEDS else -1.0
    got = sorted(own.where(F.col("norm") >= least).limit(2 * SEEDS).collect(), key=lambda r: -r.norm)  # any rows do, long ones do better
    seeds = np.array([r.vec_id for r in got]), _vectors([r.v for r in got], dim), np.array([r.norm for r in got])

    def blocks(batches):
        for ids, q, _ in _pieces(batches, dim, block):
            first = Search(ids, q, turn, k)
            for a in range(0, len(got_ids := seeds[0]), PACK):
                first.add(got_ids[a : a + PACK], seeds[1][a : a + PACK], seeds[2][a : a + PACK])
            reach = np.full(len(ids), -np.inf)
            some = first.norm > 0
            reach[some] = (first.floor[some] - 1e-6) / first.norm[some]
            need = reach.min()
            yield pa.record_batch([pa.array([x], t) for x, t in ((need - 1e-6 * abs(need) if np.isfinite(need) else need, pa.float64()), (ids.tobytes(), pa.binary()), (_bytes(q), pa.binary()), (first.floor.tobytes(), pa.binary()))], names=["need", "ids", "q", "floor"])

    def packs(batches):
        for ids, x, norms in _pieces(batches, dim, pack):
            yield pa.record_batch([pa.array([x], t) for x, t in ((norms.max(), pa.float64()), (ids.tobytes(), pa.binary()), (_bytes(x), pa.binary()), (norms.tobytes(), pa.binary()))], names=["top", "vec_ids", "x", "norms"])

    def best(s: Search) -> pa.RecordBatch:
        return pa.record_batch([pa.array(s.ids[s.best[:, 0]], pa.int64()), pa.array(s.best[:, 2], pa.int64()), pa.array(-s.best[:, 1], pa.int64())], names=["query_id", "vec_id", "score"])

    def pairs(batches):
        held: dict[bytes, Search] = {}
        for b in batches:
            for ids, q, floor, vec_ids, x, norms in zip(*(b.column(c).to_pylist() for c in ("ids", "q", "floor", "vec_ids", "x", "norms")), strict=True):
                if ids not in held:
                    if len(held) == HELD:
                        yield best(held.pop(next(iter(held))))
                    numbers = np.frombuffer(ids, np.int64)
                    held[ids] = Search(numbers, _matrix(q, len(numbers)), turn, k, np.frombuffer(floor))
                v = np.frombuffer(vec_ids, np.int64)
                held[ids].add(v, _matrix(x, len(v)), np.frombuffer(norms))
        for s in held.values():
            yield best(s)

    asking = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("norm", F.lit(0.0))
    parts = max(1, -(-own.where(F.col("vec_id") % every == 0).count() // block))
    asked = scratch.save(asking.repartition(parts, "vec_id").mapInArrow(blocks, "need double, ids binary, q binary, floor binary"), "blocks")
    packed = scratch.save(own.select("vec_id", "v", "norm").mapInArrow(packs, "top double, vec_ids binary, x binary, norms binary"), "packs")
    met = asked.join(packed, F.col("top") >= F.col("need"))
    return met.select("ids", "q", "floor", "vec_ids", "x", "norms").mapInArrow(pairs, "query_id long, vec_id long, score long")
