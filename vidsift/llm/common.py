"""What the operators of this subpackage share: scratch tables, distributed running sums, components, word batches."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a local session may do without one, a cluster may not."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        at = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(at)
    return f"{at.rstrip('/')}/vidsift"


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive a lost executor.

    Tables that a result no longer reads are kept in an inner Scratch, whose drop() deletes them at once.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.at, self.n = spark, f"{scratch_dir(spark)}/{uuid.uuid4().hex}", 0

    def inner(self) -> Scratch:
        return Scratch(self.spark)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.at}/{self.n:03d}_{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sweep(self) -> None:
        """Let Spark delete the shuffles of tables that are written: it does so when the driver's garbage is collected.

        Its listeners and scheduler let go of the last job a moment after its end, so one collection would miss that.
        """
        for _ in range(2):
            time.sleep(0.4)
            self.spark._jvm.System.gc()

    def drop(self) -> None:
        """Delete all tables of this scratch; collecting the driver's garbage lets Spark delete their shuffles."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.at)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        jvm.System.gc()


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like those wanted that are none of the taken ones, whatever their case."""
    seen = {t.lower() for t in taken}
    out = []
    for w in wanted:
        while w.lower() in seen:
            w += "_"
        seen.add(w.lower())
        out.append(w)
    return out


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def running_sum(scratch: Scratch, df: DataFrame, order: Sequence[Column], value: str, out: str, group: str | None = None, name: str = "sums") -> DataFrame:
    """Exclusive prefix sums of ``value`` in ``order``, per ``group`` if given, with no group held by one task.

    Rows are range partitioned by (group, order); each partition sums its own rows, and the totals of the
    partitions (a row for each partition and group in it) give the offsets. Ties in ``order`` fall in any order,
    so callers end it with what makes equal rows interchangeable. Columns of df may have any names.
    """
    spark = df.sparkSession
    part, total, offset, part_, group_ = fresh([*df.columns, out], "__p", "__t", "__o", "__pp", "__pg")
    keys = ([F.col(group).asc_nulls_first()] if group else []) + list(order)
    dealt = df.repartitionByRange(partitions(spark), *keys).withColumn(part, F.spark_partition_id())
    dealt = scratch.save(dealt, name)
    by = [part] + ([group] if group else [])
    own = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by).agg(F.sum(value).alias(total))
    before = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(part).alias(part_), *([F.col(group).alias(group_)] if group else []), F.coalesce(F.sum(total).over(before), F.lit(0)).alias(offset))
    same = F.col(part) == F.col(part_)
    if group:
        same = same & F.col(group).eqNullSafe(F.col(group_))
    summed = dealt.withColumn(out, F.coalesce(F.sum(value).over(own), F.lit(0)))
    return summed.join(offsets, same, "left").withColumn(out, F.col(out) + F.col(offset)).drop(*offsets.columns, part)


LINKS_A_TASK = 1_000_000


def _local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, the least vertex of each one's component): hooking and pointer jumping on arrays."""
    v, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(v))
    while True:
        rx, ry = root[x], root[y]
        live = rx != ry
        if not live.any():
            return v, v[root]
        np.minimum.at(root, np.maximum(rx, ry)[live], np.minimum(rx, ry)[live])
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def components(scratch: Scratch, edges: DataFrame, a_task: int = LINKS_A_TASK) -> DataFrame:
    """Connected components of links (a long, b long): (v, root), for every v that has a link; root is one of them.

    Each round every vertex moves to the least of itself and its neighbours in an order drawn anew, and the links
    are rewritten between what is left; the graph shrinks by a constant factor a round on average, and a hub's links
    meet only in partial minima. As soon as no more than ``a_task`` links are left, one task settles them in arrays of
    that bound. Nothing is collected.
    """
    edges = scratch.save(edges.where("a <> b"), "links")
    maps: list[DataFrame] = []
    while edges.count() > a_task:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), F.col(c)).alias("h"), F.col(c).alias("v"))
        step = both.groupBy("a").agg(F.min(rank("b")).alias("n")).select(F.col("a").alias("v"), F.least(rank("a"), F.col("n"))["v"].alias("root"))
        maps.append(step := scratch.save(step, "step"))
        left, right = step.select(F.col("v").alias("a"), F.col("root").alias("x")), step.select(F.col("v").alias("b"), F.col("root").alias("y"))
        moved = edges.join(left, "a").join(right, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = scratch.save(moved, "links")

    def settle(batches):
        held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
        if held:
            v, root = _local_roots(*map(np.concatenate, zip(*held, strict=True)))
            yield pa.record_batch([pa.array(v), pa.array(root)], names=["v", "root"])

    maps.append(scratch.save(edges.select("a", "b").coalesce(1).mapInArrow(settle, "v long, root long"), "step"))
    out = maps[0]
    for step in maps[1:]:
        nxt = step.select(F.col("v").alias("root"), F.col("root").alias("m"))
        out = out.join(nxt, "root", "left").select("v", F.coalesce("m", "root").alias("root"))
    return out


def bounded_sample(df: DataFrame, n: int, salt: int = 0) -> list:
    """``n`` rows at most, the first by a hash of the whole row; rows that are alike count as one.

    A first pass counts the different rows, a second brings those below a bound of the hash; a hash bound that lets too
    many pass ends in a limit, so the driver never holds more than 2 n + 1,000 rows.
    """
    if n <= 0:
        return []
    h = F.xxhash64(F.lit(salt), *[F.col(f"`{c}`") for c in df.columns])
    total = df.select(F.approx_count_distinct(h, 0.02)).first()[0]
    share = 1.1 * (n + 100) / max(1, total)
    if share < 1:
        df = df.where(h <= int(-(2**63) + share * 2**64))
    got = df.distinct().withColumn("__h", h).limit(2 * n + 1000).collect()
    return sorted(got, key=lambda r: (r["__h"], tuple(map(repr, r))))[:n]


def strings(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A text column as one large_string array, null as empty, that is no slice: some kernels misread slices."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    whole = pc.fill_null(column.cast(pa.large_string()), "")
    starts_at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset] if len(whole) else 0
    return whole if whole.offset == 0 == starts_at else whole.take(pa.array(np.arange(len(whole))))


def words(texts: pa.Array, split: Callable = pc.ascii_split_whitespace) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of a batch of texts: each text's first word number (and the end), each word's code, the words by code."""
    lists = split(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        offsets, flat = before[offsets], flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return offsets - offsets[0], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i, empty ones too; the offsets span all values."""
    out = np.zeros(len(offsets) - 1, np.float64 if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values.view(np.uint8) if values.dtype == bool else values, offsets[:-1][full], dtype=out.dtype)
    return out


def release() -> None:
    """Give memory that a task of this worker no longer uses back to the machine."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library: nothing to trim


def tidy(rows: Callable) -> Callable:
    """A function over a task's batches that gives its memory back when the task ends."""

    def run(batches):
        yield from rows(batches)
        release()

    return run


def text_batches(batches, limit: int = 2_000_000, text: str = "text"):
    """Record batches cut so that none holds more than about ``limit`` bytes of the text column, or one row."""
    for b in batches:
        if b.num_rows == 0:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.unique(np.searchsorted(size, np.arange(limit, size[-1] + limit, limit)) + 1)
        start = 0
        for end in np.minimum(cuts, b.num_rows):
            if end > start:
                yield b.slice(start, end - start)
                start = int(end)
        if start < b.num_rows:
            yield b.slice(start)
