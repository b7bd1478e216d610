"""A function handed in sees every landed page once, and what it returns is kept once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.writers import there


def each_page(stream: DataFrame, on_page: Callable[[DataFrame], DataFrame], keys: Sequence[str], folder: str, before_ledger: Callable[[int], None] = lambda _: None) -> StreamingQuery:
    """Start a query that calls ``on_page`` with the new pages of each micro-batch, keyed by ``keys``.

    The returned rows go to ``folder``/rows, one folder a batch that a second try replaces, and the keys seen to
    ``folder``/seen, written last. A page that an earlier batch has seen, or that lies twice in a batch, is not handed in
    again; a batch that fails midway is run again as a whole, and leaves no row twice. ``before_ledger`` is called with
    the batch's number between the two writes.
    """
    rows, seen = f"{folder}/rows", f"{folder}/seen"

    def write(pages: DataFrame, batch: int) -> None:
        spark = pages.sparkSession
        new = pages.dropDuplicates(list(keys))
        if there(spark, seen):
            earlier = spark.read.parquet(seen).where(f"batch < {batch}").select(*keys)
            new = new.join(earlier, list(keys), "left_anti")
        # both writes must see the same pages, whatever duplicate was dropped
        new.write.mode("overwrite").parquet(f"{folder}/pages/batch={batch}")
        fixed = spark.read.schema(new.schema).parquet(f"{folder}/pages/batch={batch}")
        on_page(fixed).write.mode("overwrite").parquet(f"{rows}/batch={batch}")
        before_ledger(batch)
        fixed.select(*keys).write.mode("overwrite").parquet(f"{seen}/batch={batch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
