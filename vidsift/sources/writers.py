"""Writers: appends, atomic replacement, dated partitions, CSV shape, upload gate."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upserts import replace_by_key


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def swap(df: DataFrame, path: str) -> None:
    """Write beside the table, then rename; if the new rows cannot take its place the old ones come back.

    Between the two renames the path does not exist, so readers of that instant fail and try again. One writer at a time.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}__{uuid4().hex}"
    df.write.parquet(fresh)
    fs, target = _fs(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(fresh)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{fresh}_old")
    held = fs.exists(target)
    if held and not fs.rename(target, old):
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(new, target):
        if held:
            fs.rename(old, target)
        raise OSError(f"{fresh} could not be renamed to {path}")
    fs.delete(old, True)


def backed_up(spark: SparkSession, path: str) -> str:
    """Rename the table at ``path`` to a copy of its own and leave an empty one of its schema; the copy's path."""
    rows = spark.read.parquet(path)
    copy = f"{path.rstrip('/')}__backup_{uuid4().hex}"
    fs, target = _fs(spark, path)
    schema = rows.schema
    if not fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(copy)):
        raise OSError(f"{path} could not be renamed")
    spark.createDataFrame([], schema).write.parquet(path)
    return copy


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete tables; absent ones are no error."""
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def widened(df: DataFrame, **columns: str) -> DataFrame:
    """Columns of given types that the frame lacks are added as nulls; others stay as they are."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def upsert(rows: DataFrame, path: str, key: str, order: Sequence[Column]) -> None:
    """Replace rows by key in the table at ``path``, which may not exist yet."""
    spark = rows.sparkSession
    fs, p = _fs(spark, path)
    target = spark.read.parquet(path) if fs.exists(p) else spark.createDataFrame([], rows.schema)
    swap(replace_by_key(target, rows, key, order), path)


def append(df: DataFrame, path: str, kind: str = "parquet") -> None:
    df.write.mode("append").format(kind).save(path)


def dated(df: DataFrame, path: str, column: str = "collection_date") -> None:
    """One folder a day; writing a day again replaces that day only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def csv_shape(df: DataFrame, lead: Sequence[str]) -> DataFrame:
    """Lead columns first; lists joined by bars, structs as JSON, null as empty."""
    out = []
    for name in [*[c for c in lead if c in df.columns], *[c for c in df.columns if c not in lead]]:
        kind, c = dict(df.dtypes)[name], F.col(f"`{name}`")
        text = F.array_join(c.cast("array<string>"), "|") if kind.startswith("array<") and "struct" not in kind else F.to_json(c) if kind.startswith(("array", "struct", "map")) else c.cast("string")
        out.append(F.coalesce(text, F.lit("")).alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, lead: Sequence[str] = (), mark: bool = False) -> None:
    """CSV files with a header each; with ``mark`` a byte order mark opens each file, as spreadsheets want it."""
    shaped = csv_shape(df, lead)
    if mark:
        shaped = shaped.withColumnRenamed(shaped.columns[0], "\ufeff" + shaped.columns[0])
    shaped.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def gate(df: DataFrame, day: str, least_failed: int = 0, date: str = "collection_date", status: str = "collection_status") -> DataFrame:
    """One row of counts for an export of ``day``, with the reason it must not be uploaded, or null."""
    c = df.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col(date).cast("string"), F.lit("")) != day).alias("other_days"), F.count_if(F.col(status) == "api_failed").alias("failed"))
    why = F.when(F.col("rows") == 0, "no rows").when(F.col("other_days") > 0, "rows of other days").when(F.col("failed") < least_failed, "fewer failed rows than failed handles")
    return c.withColumn("reason", why)


def there(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)
