"""Row-level operators: status backfill, defaults, checks of ids and dates, notes, samples in a stated order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as T
from ..operators import upserts as U
from ..registry import query
from ..session import table


@query("""
SELECT s_suppkey, CASE WHEN s IS NULL AND NOT starts_with(id, 'failed_') THEN 'ok' ELSE s END AS status
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'partial' END AS s, CASE WHEN s_suppkey % 4 = 0 THEN 'failed_' ELSE '' END || s_name AS id FROM supplier)""")
def k15_status_backfill(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "partial").alias("status"), F.concat(F.when(F.col("s_suppkey") % 4 == 0, "failed_").otherwise(""), F.col("s_name")).alias("id"))
    return U.update_where(s, F.col("status").isNull() & ~F.startswith("id", F.lit("failed_")), status=F.lit("ok")).select("s_suppkey", "status")


@query("""SELECT s_suppkey, s_name, 'pipeline_3' AS pipeline_id, 'keyword' AS collection_source, s_nationkey FROM supplier""")
def p06_constant_columns(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit("pipeline_3").alias("pipeline_id"), F.lit("keyword").alias("collection_source"), "s_nationkey")


@query("""SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def p14_relative_time(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts")
    return e.join(F.broadcast(e.agg(F.max("ts").alias("now"))), F.col("ts") > F.col("now") - F.expr("INTERVAL 7 DAYS")).select("event_id", "ts")


@query("""SELECT p_partkey, p_name FROM part WHERE NOT starts_with(p_type, 'PROMO')""")
def p17_not_stub(spark, sf) -> DataFrame:
    return table(spark, sf, "part").where(~F.startswith("p_type", F.lit("PROMO"))).select("p_partkey", "p_name")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 50000""")
def p18_any_condition(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where((F.col("o_orderstatus") == "P") | (F.col("o_totalprice") < 50000)).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(r"""
SELECT s_suppkey, map_extract(MAP {'1': 'creators', 'p1': 'creators', 'creators': 'creators', 'p2': 'news', 'news': 'news'}, raw)[1] AS pipeline, regexp_full_match(day, '\d{4}-\d{2}-\d{2}') AS good_day
FROM (SELECT s_suppkey, ['1', 'p1', 'news', 'p9'][(s_suppkey % 4) + 1] AS raw, CASE WHEN s_suppkey % 2 = 0 THEN '2026-09-01' ELSE '20260901' END AS day FROM supplier)""")
def p27_canonical_ids(spark, sf) -> DataFrame:
    alias = F.create_map(*[F.lit(x) for x in ("1", "creators", "p1", "creators", "creators", "creators", "p2", "news", "news", "news")])
    raw = F.get(F.array(*map(F.lit, ("1", "p1", "news", "p9"))), F.col("s_suppkey") % 4)
    day = F.when(F.col("s_suppkey") % 2 == 0, "2026-09-01").otherwise("20260901")
    return table(spark, sf, "supplier").select("s_suppkey", F.try_element_at(alias, raw).alias("pipeline"), day.rlike(r"^\d{4}-\d{2}-\d{2}$").alias("good_day"))


@query("""
SELECT c_custkey, coalesce(n, 0)::BIGINT AS n_orders, coalesce(p, 0)::BIGINT AS n_open
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS p FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def j18_counts_default_zero(spark, sf) -> DataFrame:
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("p"))
    return table(spark, sf, "customer").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("p", F.lit(0)).alias("n_open"))


@query("""
SELECT count(*) AS total, count(*) FILTER (trim(coalesce(text, '')) <> '') AS with_text, count(*) FILTER (lang IS NOT NULL AND lang <> '') AS with_lang, count(*) FILTER (n_chars >= 200) AS long_text FROM documents""")
def a33_layer_coverage(spark, sf) -> DataFrame:
    some = lambda c: F.count_if(F.trim(F.coalesce(c, F.lit(""))) != "")
    return table(spark, sf, "documents").agg(F.count("*").alias("total"), some("text").alias("with_text"), some("lang").alias("with_lang"), F.count_if(F.col("n_chars") >= 200).alias("long_text"))


@query("""SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey DESC LIMIT 20""")
def o06_head_of_order(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").orderBy(F.desc("o_orderkey")).limit(20)


@query("""
SELECT s_suppkey, score >= 50 AND (why = 'exact_x_handle' OR why = 'outlet_in_bio') AS high_confidence
FROM (SELECT s_suppkey, s_suppkey % 7 * 15 AS score, ['exact_x_handle', 'followers', 'outlet_in_bio'][(s_suppkey % 3) + 1] AS why FROM supplier)""")
def t07_high_confidence(spark, sf) -> DataFrame:
    why = F.get(F.array(*map(F.lit, ("exact_x_handle", "followers", "outlet_in_bio"))), F.col("s_suppkey") % 3)
    return table(spark, sf, "supplier").select("s_suppkey", ((F.col("s_suppkey") % 7 * 15 >= 50) & why.isin("exact_x_handle", "outlet_in_bio")).alias("high_confidence"))


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN trim(coalesce(text, '')) = '' THEN 'text' END, CASE WHEN coalesce(lang, '') <> 'en' THEN 'english' END, CASE WHEN n_chars < 200 THEN 'length' END) AS missing FROM documents""")
def t44_missing_layers(spark, sf) -> DataFrame:
    lack = (("text", F.trim(F.coalesce("text", F.lit(""))) == ""), ("english", F.coalesce("lang", F.lit("")) != "en"), ("length", F.col("n_chars") < 200))
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(",", *[F.when(c, n) for n, c in lack]).alias("missing"))


@query("""SELECT event_id, left(trim(split_part(event_type || 'Error: code ' || user_id, ':', 1)), 80) AS error_type FROM events""")
def t50_error_type(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", X.error_type(F.concat(F.col("event_type"), F.lit("Error: code "), F.col("user_id").cast("string"))).alias("error_type"))


@query("""
SELECT event_id, concat_ws(' ', CASE WHEN event_type = 'error' THEN 'internal_error' END, 'status', user_id::VARCHAR, CASE WHEN value > 50 THEN 'too large' END) AS message FROM events""")
def t68_page_error_text(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.concat_ws(" ", F.when(F.col("event_type") == "error", "internal_error"), F.lit("status"), F.col("user_id").cast("string"), F.when(F.col("value") > 50, "too large")).alias("message"))


@query("""SELECT doc_id, 'lang=' || coalesce(lang, '') || '; source=' || coalesce(source, '') || '; chars=' || coalesce(n_chars, 0) AS note FROM documents""")
def t69_note(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.format_string("lang=%s; source=%s; chars=%d", F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")), F.coalesce("n_chars", F.lit(0))).alias("note"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS first_day, strftime(o_orderdate, '%Y%m%d') AS last_day FROM orders""")
def c03_utc_day(spark, sf) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    first, last = T.api_dates(day.cast("timestamp"), F.date_add(day, 1).cast("timestamp"))
    return table(spark, sf, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


@query("""
SELECT count(*) FILTER (posted IS NULL OR posted = '') AS absent, count(*) FILTER (posted <> '' AND try_strptime(posted, '%Y-%m-%d') IS NULL) AS bad, count(*) FILTER (try_strptime(posted, '%Y-%m-%d') IS NOT NULL) AS good
FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'soon' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS posted FROM orders)""")
def c09_time_validity(spark, sf) -> DataFrame:
    k = F.col("o_orderkey") % 4
    posted = F.when(k == 0, "").when(k == 1, "soon").when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = table(spark, sf, "orders").select(posted.alias("p")).withColumn("t", F.try_to_timestamp("p", F.lit("yyyy-MM-dd")))
    absent = F.col("p").isNull() | (F.col("p") == "")
    return d.agg(F.count_if(absent).alias("absent"), F.count_if(~absent & F.col("t").isNull()).alias("bad"), F.count_if(F.col("t").isNotNull()).alias("good"))
