"""Relational building blocks: one plan each, no actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def missing(c: Column | str) -> Column:
    """Null and the empty string are one state."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("")) == ""


def first_filled(*cs: Column) -> Column:
    """The first value that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, null for an empty whole."""
    return F.round(F.try_divide(part * 100.0, whole), digits)


def row_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; the order must end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of each group; Spark prunes with a partial window limit before the shuffle."""
    out = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n)
    return out.withColumnRenamed("__rn", rank) if rank else out.drop("__rn")


def duplicated(df: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(n)).where(F.col(n) > 1)


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done. An anti join keeps rows that NOT IN would lose to a null."""
    return df.join(done.select(key), key, "left_anti")


def any_of(df: DataFrame, key: str, *keyed: DataFrame) -> DataFrame:
    """Rows whose key occurs in any of the frames (each with that key as its only column)."""
    union = keyed[0]
    for k in keyed[1:]:
        union = union.unionByName(k)
    return df.join(union, key, "left_semi")


def with_children(parent: DataFrame, child: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], out: str) -> DataFrame:
    """Child rows as an ordered array, joined once; an empty array for none."""
    kids = child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias("__k"))
    joined = parent.join(kids, key, "left")
    made = F.transform("__k", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return joined.withColumn(out, F.coalesce(made, F.array())).drop("__k")


def latest(df: DataFrame, keys: Sequence[str], by: str, fields: Sequence[str]) -> DataFrame:
    """Fields of the row with the greatest ``by``: one partial aggregate, no sort."""
    s = F.max_by(F.struct(*fields), by)
    return df.groupBy(*keys).agg(s.alias("__s")).select(*keys, *[F.col(f"__s.{f}").alias(f) for f in fields])


def mode_first_seen(df: DataFrame, keys: Sequence[str], value: str, seen: str) -> DataFrame:
    """The most frequent value of each key; ties go to the one seen first."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seen).alias("at"))
    return n.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", (-F.col("at")).alias("at"))).alias("s")).select(*keys, F.col(f"s.{value}").alias(value), F.col("s.n").alias("n"))


def streaks(df: DataFrame, key: str, order: Sequence[str], failed: Column) -> DataFrame:
    """Adds n (attempts so far), failures so far, and the length of the current run of failures."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("failed", failed.cast("int"))
    d = d.withColumn("attempts", F.count("*").over(w)).withColumn("failures", F.sum("failed").over(w)).withColumn("__island", F.sum(1 - F.col("failed")).over(w))
    run = Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("in_a_row", F.sum("failed").over(run)).drop("__island")


def keep_best(df: DataFrame, key: str, prints: dict[str, Column]) -> DataFrame:
    """All rows that equal their key's greatest row in the given fields, the first field deciding, null least.

    The greatest is a partial aggregate. Rows meet it by key and by a hash of the fields, so the rows of a hot key that
    lose are spread over all tasks and only those that stay share one.
    """
    made = F.struct(*[c.alias(n) for n, c in prints.items()])
    d = df.withColumn("__print", made)
    best = d.groupBy(F.col(key).alias("__key")).agg(F.max("__print").alias("__best")).withColumn("__hash", F.xxhash64("__best"))
    same = (F.col(key) == F.col("__key")) & (F.xxhash64("__print") == F.col("__hash")) & F.col("__print").eqNullSafe(F.col("__best"))
    return d.join(best, same, "left_semi").drop("__print")


def numbered(df: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Adds the place of each row in a total order; the order must end in a unique column.

    Rows are dealt by ranges of the order and written once; each range numbers its own rows, and the sizes of the ranges,
    a row each, give the offsets, so no task sees all rows.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    placed = dealt.withColumn("__own", own).join(F.broadcast(offsets), "__part")  # a row a partition
    return placed.withColumn(name, (F.col("__own") + F.col("__before") + (first - 1)).cast("int")).drop("__part", "__own", "__before")
