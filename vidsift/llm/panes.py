"""Window panes with revisions: hourly totals by kind that are published after a grace period and then corrected.

A stateful stream holds one pane for each (kind, hour): current and published totals, and two event-time timers. The
grace timer publishes the pane, the close timer forgets it; rows in between correct what was published, and rows behind
the close are handed out one by one. Batches arrive one after another, each in a start of its own of the same query on
the same checkpoint; every batch ends in a sentinel row, so that empty ones run too, and the last sentinel lies beyond
all time, so that the remaining panes are published as final.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .common import Scratch

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
#: Spark's first watermark is 1970, so the stream counts time from so many days earlier: before year 1.
SHIFT_US = 4_000_000 * DAY_US
#: The last sentinel's time: so many days after 1970, beyond year 9999.
FOREVER_US = 4_000_000 * DAY_US
LANES = 64
ROW = "batch long, record string, kind string, hour long, click_id long, n_rows long, cents long"
PARTIAL = "kind string, hour long, lane int, click_id long, n_rows long, cents long"
#: The store of timers and values. It has a small store a partition, so none sets 4 MB of disk aside beforehand; stores of
#: ended starts leave the executors' disks within seconds, not minutes; a batch stores its changes, not all state anew.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.maintenanceInterval": "1s",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def combine(batches, closed_us: int | None, keep_us: int, pending: int = 100_000):
    """Rows of a task added up by pane before they are shuffled, so that a hot pane gets a row from each task.

    Rows of panes that are closed stay single and go to one of ``LANES`` lanes by their id, so that a hot closed hour
    is no single task. ``closed_us`` is the watermark of the batch, None for none.
    """
    held: list[pa.Table] = []

    def added():
        t = pa.concat_tables(held).group_by(["kind", "hour"], use_threads=False).aggregate([("n_rows", "sum"), ("cents", "sum")])
        n = t.num_rows
        return pa.table([t["kind"], t["hour"], pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, -1)), t["n_rows_sum"], t["cents_sum"]], names=["kind", "hour", "lane", "click_id", "n_rows", "cents"])

    for b in batches:
        if not b.num_rows:
            continue
        hour, sentinel = b.column("hour").to_numpy(), b.column("sentinel").to_numpy(zero_copy_only=False).astype(bool)
        late = ~sentinel & (np.zeros(len(hour), bool) if closed_us is None else (hour + 1) * HOUR_US + keep_us <= closed_us)
        lane = np.where(sentinel, -1, 1 + pc.fill_null(b.column("click_id"), 0).to_numpy() % LANES).astype(np.int32)
        single = pa.array(late | sentinel)
        ones = pa.array(np.ones(b.num_rows, np.int64))
        whole = pa.table([b.column("kind"), b.column("hour"), pa.array(lane), b.column("click_id"), ones, b.column("cents")], names=["kind", "hour", "lane", "click_id", "n_rows", "cents"])
        yield from whole.filter(single).to_batches()
        held.append(whole.filter(pc.invert(single)))
        if sum(t.num_rows for t in held) > pending:
            held = [added()]
            if held[0].num_rows > pending // 2:
                yield from held.pop().to_batches()
    if held:
        yield from added().to_batches()


class Panes(StatefulProcessor):
    """State and timers of one (kind, hour); the lane tells open panes (0) from late rows and sentinels."""

    def __init__(self, batch: int, grace_ms: int, keep_ms: int):
        self.batch, self.grace, self.keep = batch, grace_ms, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n_rows long, cents long, published boolean, out_rows long, out_cents long")

    def _out(self, key, *records) -> pd.DataFrame:
        kind, hour, _ = key
        return pd.DataFrame([(self.batch, record, kind, int(hour), -1, n, cents) for record, n, cents in records], columns=["batch", "record", "kind", "hour", "click_id", "n_rows", "cents"])

    def _end(self, key) -> int:
        """When the pane's hour ends, in the stream's milliseconds."""
        return (int(key[1]) + 1) * 3_600_000 + SHIFT_US // 1000

    def handleInputRows(self, key, rows, timerValues):
        lane = int(key[2])
        if lane < 0:
            for _ in rows:
                pass
            return
        closed = timerValues.getCurrentWatermarkInMs() >= self._end(key) + self.keep
        if closed != (lane > 0):
            raise RuntimeError("the stream's watermark is not the one its rows were dealt by")
        if closed:
            for x in rows:
                yield x.assign(batch=self.batch, record="late")[["batch", "record", "kind", "hour", "click_id", "n_rows", "cents"]]
            return
        n = cents = 0
        for x in rows:
            n += int(x["n_rows"].sum())
            cents += int(x["cents"].sum())
        had = self.totals.get()
        if had is None:
            self.handle.registerTimer(self._end(key) + self.grace - 1)  # timers fire once the watermark is past them
            self.totals.update((n, cents, False, 0, 0))
            return
        had_n, had_cents, published, out_n, out_cents = had
        n, cents = n + had_n, cents + had_cents
        if published:
            self.totals.update((n, cents, True, n, cents))
            yield self._out(key, ("retract", out_n, out_cents), ("replace", n, cents))
        else:
            self.totals.update((n, cents, False, 0, 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if expiredTimerInfo.getExpiryTimeInMs() >= self._end(key) + self.keep - 1:
            self.totals.clear()
            return
        n, cents, *_ = self.totals.get()
        now = timerValues.getCurrentWatermarkInMs()
        if now >= self._end(key) + self.keep:
            self.totals.clear()
        else:
            self.totals.update((n, cents, True, n, cents))
            self.handle.registerTimer(self._end(key) + self.keep - 1)
        yield self._out(key, ("final" if now >= (FOREVER_US + SHIFT_US) // 1000 else "emit", n, cents))


def _with(spark, settings: dict[str, str], act: Callable[[], None]) -> None:
    """Do something under other settings of the session, and put them back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        act()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def revisions(rows: DataFrame, n_batches: int, grace_hours: int = 6, keep_hours: int = 96) -> DataFrame:
    """What the stream writes (ROW) for ``rows``: (batch int, kind string, event_us long, click_id long, cents long).

    ``batch`` runs from 0 to n_batches - 1; event_us are microseconds since 1970, also negative. The watermark of a batch
    is the latest event time of all earlier ones. A pane is published (`emit`) once the watermark is ``grace_hours`` past
    its hour, corrected (`retract`, `replace`) by later rows, and forgotten ``keep_hours`` past it; rows that come after
    that are `late`, with their click_id. What no batch published, the last one does (`final`). A null kind is `none`,
    null cents count 0; rows without event_us or batch are dropped. No rows at all give no rows.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    staged, landed, kept, out = (f"{scratch.at}/{x}" for x in ("staged", "landed", "checkpoint", "out"))
    given = rows.where(F.col("event_us").isNotNull() & F.col("batch").isNotNull()).select(
        F.coalesce("kind", F.lit("none")).alias("kind"),
        F.expr(f"(event_us - pmod(event_us, {HOUR_US})) div {HOUR_US}").alias("hour"),
        F.col("event_us").cast("long").alias("event_us"),
        F.col("click_id").cast("long").alias("click_id"),
        F.coalesce(F.col("cents").cast("long"), F.lit(0).cast("long")).alias("cents"),
        F.lit(False).alias("sentinel"),
        F.col("batch").cast("int").alias("batch"),
    )
    given.write.partitionBy("batch").parquet(staged)
    schema = given.schema
    staged_rows = spark.read.schema(schema).parquet(staged)
    newest = {r.batch: r.at for r in staged_rows.groupBy("batch").agg(F.max("event_us").alias("at")).collect()}
    plain = given.drop("batch").schema
    grace_ms, keep_ms = grace_hours * 3_600_000, keep_hours * 3_600_000
    watermark = None

    def start(batch: int) -> None:
        stream = spark.readStream.schema(plain).parquet(landed)
        stream = stream.withColumn("at", F.timestamp_micros(F.col("event_us") + SHIFT_US)).withWatermark("at", "0 seconds")
        seen, keep_us = watermark, keep_ms * 1000
        # the timed column ends here: Spark itself would drop rows behind the watermark that this operator hands out
        partial = stream.select("kind", "hour", "click_id", "cents", "sentinel").mapInArrow(lambda b: combine(b, seen, keep_us), PARTIAL)
        panes = partial.groupBy("kind", "hour", "lane").transformWithStateInPandas(Panes(batch, grace_ms, keep_ms), ROW, "Append", "EventTime")
        query = panes.writeStream.format("parquet").option("path", out).option("checkpointLocation", kept).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()

    for batch in range(n_batches):
        last = batch == n_batches - 1
        at = FOREVER_US if last else -SHIFT_US
        mark = spark.range(1).select(F.lit("").alias("kind"), F.lit(0).cast("long").alias("hour"), F.lit(at).cast("long").alias("event_us"), F.lit(None).cast("long").alias("click_id"), F.lit(0).cast("long").alias("cents"), F.lit(True).alias("sentinel"))
        staged_rows.where(F.col("batch") == batch).drop("batch").unionByName(mark).write.mode("append").parquet(landed)
        # only the last start runs on without data: then the sentinel's watermark publishes what is left
        _with(spark, SETTINGS | {NO_DATA: str(last).lower()}, lambda n=batch: start(n))
        if batch in newest:
            watermark = max(newest[batch], newest[batch] if watermark is None else watermark)
    return spark.read.schema(ROW).parquet(out)
