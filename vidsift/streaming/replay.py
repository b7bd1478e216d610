"""Starts of one streaming query after another on one checkpoint, each over the files that came in since the last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Keyed state is kept in this store. Its many small parts set no disk aside beforehand, store changes rather than all
#: state, and leave the executors' disks soon after their query ends.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "1s",
}


def drain(spark: SparkSession, begin: Callable[[], StreamingQuery]) -> None:
    """Start a query with an available-now trigger and wait for its end, under the settings that kept state needs."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        begin().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def replay(rows: DataFrame, batch: str, batches: int, folder: str, begin: Callable[[DataFrame], StreamingQuery]) -> None:
    """Hand the rows of batch 0, 1, ... in order to a query that is started anew for each of them.

    ``rows`` are staged under ``folder`` once, split by their batch, and copied to the folder that the stream reads when
    their turn comes. ``begin`` makes a query of the stream; its checkpoint is what the starts share, so that state and
    finished files are those of one unbroken run.
    """
    spark = rows.sparkSession
    schema = rows.drop(batch).schema
    rows.withColumn(batch, F.col(batch).cast("int")).write.partitionBy(batch).parquet(f"{folder}/staged")
    staged = spark.read.schema(rows.withColumn(batch, F.col(batch).cast("int")).schema).parquet(f"{folder}/staged")
    for n in range(batches):
        staged.where(F.col(batch) == n).drop(batch).write.mode("append").parquet(f"{folder}/landed")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/landed")
        drain(spark, lambda s=stream: begin(s))
