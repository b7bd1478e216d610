"""Stored tables: added columns, a layout for point lookups, exports whose counts are taken while they are written."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut
from . import writers

SLOTS = 16
CHUNK_DAYS = 30


def add_missing_columns(spark: SparkSession, table: str, wanted: StructType | str) -> list[str]:
    """Columns of ``wanted`` that a catalogue table lacks are added to it; their names. Rows written before have nulls."""
    wanted = StructType.fromDDL(wanted) if isinstance(wanted, str) else wanted
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in wanted if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]


def stored_table(spark: SparkSession, name: str, schema: str, path: str) -> str:
    """An external Parquet table of its own name at a path; dropping it leaves the files."""
    full = f"{name}_{uuid4().hex}"
    spark.sql(f"CREATE TABLE {full} ({schema}) USING parquet LOCATION '{path}'")
    return full


def slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def lay_out(df: DataFrame, key: str, at: str, path: str, slots: int = SLOTS) -> None:
    """Store rows by 30-day chunk of ``at`` and by a hash slot of ``key``, so that a lookup reads few files."""
    chunk = F.floor(F.unix_date(F.col(at).cast("date")) / CHUNK_DAYS).cast("int")
    df.withColumn("chunk", chunk).withColumn("slot", slot(F.col(key), slots)).write.partitionBy("chunk", "slot").parquet(path)


def lookup(store: DataFrame, key: str, wanted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows of the wanted keys; only folders of slots that hold one are read."""
    keys = wanted.select(key).distinct().withColumn("slot", slot(F.col(key), slots))
    there = [r.slot for r in keys.select("slot").distinct().collect()]  # as many numbers as there are slots, at most
    return store.where(F.col("slot").isin(there)).join(keys, [key, "slot"], "left_semi")


def newest_first(store: DataFrame, key: str, wanted: DataFrame, order: list[str], slots: int = SLOTS) -> DataFrame:
    """The newest row of each wanted key: the newest chunk is read first, older ones only for keys not found yet."""
    chunks = [r.chunk for r in store.select("chunk").distinct().orderBy(F.desc("chunk")).collect()]  # folders, not rows
    left = cut(wanted.select(key).distinct())
    fields = [c for c in store.columns if c != key]
    found = None
    for n, chunk in enumerate(chunks):
        best = F.max_by(F.struct(*fields), F.struct(*order)).alias("row")
        hits = lookup(store.where(F.col("chunk") == chunk), key, left, slots).groupBy(key).agg(best).select(key, "row.*")
        found = cut(hits) if found is None else found.unionByName(hits := cut(hits))
        left = cut(left.join(found.select(key), key, "left_anti")) if n + 1 < len(chunks) else left
        if left.isEmpty():
            break
    return found if found is not None else store.limit(0)


def export(df: DataFrame, path: str, day: str, lead: tuple[str, ...] = (), least_failed: int = 0, date: str = "collection_date", status: str = "collection_status") -> dict[str, int]:
    """Write a day's rows as CSV and return their counts; ValueError if the export must not be uploaded.

    Rows, rows of other days and failed ones are counted as they are written; the header and the number of rows are then
    read back from the files and compared, so that a file that lost rows is refused. No rows at all are refused where
    failures are known, and so are fewer failed rows than failed handles.
    """
    seen = Observation(f"export_{uuid4().hex}")
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.count_if(F.coalesce(F.col(date).cast("string"), F.lit("")).isin("", day) == F.lit(False)), F.lit(0)).alias("other_days"),
        F.coalesce(F.count_if(F.col(status) == "api_failed"), F.lit(0)).alias("failed"),
    )
    writers.write_csv(counted, path, lead)
    return verify(df.sparkSession, path, dict(seen.get), [*[c for c in lead if c in df.columns], *[c for c in df.columns if c not in lead]], day, least_failed)


def verify(spark: SparkSession, path: str, counts: dict[str, int], columns: list[str], day: str, least_failed: int = 0) -> dict[str, int]:
    """Compare an export's files with the counts taken when they were written."""
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if counts["rows"] and back.columns != columns:
        raise ValueError(f"{path}: header {back.columns} is not {columns}")
    again = back.count() if back.columns else 0
    if again != counts["rows"]:
        raise ValueError(f"{path}: {counts['rows']} rows written, {again} read back")
    if counts["other_days"]:
        raise ValueError(f"{path}: {counts['other_days']} rows of other days than {day}")
    if least_failed and not counts["rows"]:
        raise ValueError(f"{path}: no rows, but {least_failed} failed handles")
    if counts["failed"] < least_failed:
        raise ValueError(f"{path}: {counts['failed']} failed rows for {least_failed} failed handles")
    return counts | {"read_back": again}


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, p = writers._fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def archive(spark: SparkSession, source: str, root: str, prefix: str, day: str) -> dict[str, object]:
    """Copy an export to ``root``/``prefix``/``day``, in place of what was there; OSError unless all bytes arrive.

    The copy is made beside its place and renamed, so a failed copy leaves the archived object as it was.
    """
    import datetime

    if datetime.date.fromisoformat(day).isoformat() != day:
        raise ValueError(f"{day} is no day of the form 2024-01-31")
    target, fresh = f"{root}/{prefix}/{day}", f"{root}/{prefix}/_{day}_{uuid4().hex}"
    fs, place = writers._fs(spark, target)
    new = spark._jvm.org.apache.hadoop.fs.Path(fresh)
    had = fs.exists(place)
    source_fs, origin = writers._fs(spark, source)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, origin, fs, new, False, spark._jsc.hadoopConfiguration())
    size, want = stored_bytes(spark, fresh), stored_bytes(spark, source)
    if not size or size != want:
        fs.delete(new, True)
        raise OSError(f"{target}: {size} of {want} bytes arrived")
    fs.delete(place, True)
    if not fs.rename(new, place):
        raise OSError(f"{fresh} could not be renamed to {target}")
    return {"uri": target, "bytes": size, "replaced": had}
