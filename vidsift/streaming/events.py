"""The worker log as a stream: incremental counts, keyword merging and failure streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import upsert

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def log_stream(spark: SparkSession, folder: str, schema: str = EVENTS) -> DataFrame:
    """New files of a folder as rows; progress is in the stream's checkpoint, so finished files are not read again."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(events: DataFrame, late: str | None = "2 days") -> DataFrame:
    """Counts by hour and stage; rows later than ``late`` behind the newest are dropped by the watermark. None if the
    rows have a watermark already."""
    w = (events.withWatermark("ts", late) if late else events).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


def window_only(events: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Rows inside a half-open window, and those outside, to be counted rather than lost."""
    inside = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    return events.where(inside), events.where(~F.coalesce(inside, F.lit(False)))


def distinct_events(events: DataFrame, late: str = "2 days") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def upsert_sink(path: str, key: str, order: str):
    """For foreachBatch: the newest row of each key replaces what the table holds; replaying a batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, path, key, [F.desc(order)])

    return write
