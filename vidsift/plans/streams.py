"""Streams that keep state, replayed over whole tables: progress, breaker, page callback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import query
from ..session import table
from ..sources import landed as L
from ..streaming import progress as P
from ..streaming.callback import each_page
from ..streaming.replay import replay

#: Pages of the log: a third of the purchases end their unit.
KINDS = "CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'last' ELSE 'page' END"
DAYS_A_BATCH = 8


def _log(spark, sf) -> DataFrame:
    """The worker log in batches of eight days each, by the day of the month."""
    e = table(spark, sf, "events").withColumn("at", F.col("ts"))
    return e.withColumn("batch", F.floor((F.dayofmonth("ts") - 1) / DAYS_A_BATCH).cast("int"))


@query("""
WITH e AS (
  SELECT user_id || '|' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS unit, event_id, props,
         CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'last' ELSE 'page' END AS kind,
         row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS n
  FROM events),
c AS (SELECT unit, count(*) AS total, bool_or(n = 1 AND kind = 'error') AS failed, min(n) FILTER (WHERE kind = 'last') AS done FROM e GROUP BY unit),
a AS (
  SELECT unit, any_value(total) AS total, any_value(failed) AS failed, any_value(done) AS done, count(*) AS used,
         count(*) FILTER (WHERE kind <> 'error') AS pages, arg_max(event_id, n) FILTER (WHERE kind <> 'error') AS cursor, arg_max(props, n) FILTER (WHERE kind = 'error') AS error
  FROM e JOIN c USING (unit) WHERE n <= CASE WHEN failed THEN 1 ELSE coalesce(done, total) END GROUP BY unit)
SELECT unit, CASE WHEN failed THEN 'failed' WHEN done IS NOT NULL THEN 'completed' WHEN error IS NOT NULL THEN 'partial' ELSE 'running' END AS status,
       cursor, pages, CASE WHEN done IS NULL OR failed THEN error END AS error, total - used AS skipped FROM a""")
def st2_resumable_progress(spark, sf) -> DataFrame:
    """Progress of each user's weeks, kept by a stream that stops and resumes between batches; weeks reach across them."""
    folder = L.workspace(spark, "progress")
    unit = F.concat_ws("|", F.col("user_id").cast("string"), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    log = _log(spark, sf).select(unit.alias("unit"), "at", "event_id", F.expr(KINDS).alias("kind"), F.col("props").alias("detail"), "batch")
    replay(log, "batch", 4, folder, lambda s: P.follow(s, f"{folder}/states", f"{folder}/checkpoint"))
    return P.current(spark.read.schema(P.PROGRESS).parquet(f"{folder}/states"))


@query("""
WITH a AS (
  SELECT user_id AS collector, event_id, ts, CASE WHEN event_type = 'error' THEN 'error' ELSE 'page' END AS kind,
         row_number() OVER w AS tried, sum((event_type = 'error')::INTEGER) OVER w AS failed, sum((event_type <> 'error')::INTEGER) OVER w AS island
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum((kind = 'error')::INTEGER) OVER (PARTITION BY collector, island ORDER BY ts, event_id) AS run FROM a),
s AS (
  SELECT *, CASE WHEN kind = 'error' AND run >= 3 THEN 'consecutive_failures' WHEN tried >= 20 AND failed >= 0.25 * tried THEN 'failure_rate' END AS stop_reason FROM r),
f AS (SELECT collector, min(tried) AS last FROM s WHERE stop_reason IS NOT NULL GROUP BY 1)
SELECT collector, event_id, kind, stop_reason FROM s LEFT JOIN f USING (collector) WHERE tried <= coalesce(last, tried)""")
def st7_breaker_stream(spark, sf) -> DataFrame:
    """What collectors pass on until their third failure in a row, or a quarter of 20 attempts or more, stops them."""
    folder = L.workspace(spark, "breaker")
    kind = F.when(F.col("event_type") == "error", "error").otherwise("page")
    log = _log(spark, sf).select(F.col("user_id").alias("collector"), "at", "event_id", kind.alias("kind"), "batch")
    replay(log, "batch", 4, folder, lambda s: P.guard(s, f"{folder}/passed", f"{folder}/checkpoint", in_a_row=3))
    return spark.read.schema(P.PASSED).parquet(f"{folder}/passed")


@query("""
SELECT user_id, event_id // 50 AS page, count(*) AS items, count_if(event_type = 'error')::BIGINT AS errors, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS kinds
FROM events GROUP BY 1, 2""")
def x02_page_callback(spark, sf) -> DataFrame:
    """A function handed in sees each page of a user's events once, though batches land a third of the pages again."""
    folder = L.workspace(spark, "callback")
    item = F.struct("event_id", "event_type")
    page = F.floor(F.col("event_id") / 50)
    pages = table(spark, sf, "events").groupBy("user_id", page.alias("page")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    first = F.pmod(F.col("page"), F.lit(3)).cast("int")
    twice = pages.withColumn("batch", first).unionByName(pages.where("page % 3 = 0").withColumn("batch", F.lit(2)))

    def on_page(new: DataFrame) -> DataFrame:
        kinds = F.array_sort(F.array_distinct(F.col("items.event_type")))
        errors = F.size(F.filter("items", lambda x: x["event_type"] == "error")).cast("long")
        return new.select("user_id", "page", F.size("items").cast("long").alias("items"), errors.alias("errors"), F.array_join(kinds, "|").alias("kinds"))

    replay(twice, "batch", 3, folder, lambda s: each_page(s, on_page, ["user_id", "page"], folder))
    return spark.read.schema("user_id long, page long, items long, errors long, kinds string").parquet(f"{folder}/rows/batch=*")
