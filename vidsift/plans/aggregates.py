"""Monitoring, coverage, cost and frequency queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..registry import query
from ..session import table


def day_of(c: str = "o_orderdate"):
    return F.date_format(c, "yyyy-MM-dd")


@query("SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM documents) AS n_documents")
def a01_row_counts(spark, sf) -> DataFrame:
    one = lambda t, c: table(spark, sf, t).agg(F.count("*").alias(c))
    return one("orders", "n_orders").crossJoin(one("documents", "n_documents"))  # one row each


@query("""
SELECT count(*) AS n, count_if(coalesce(text, '') <> '')::BIGINT AS with_text, count_if(length(coalesce(text, '')) >= 1000)::BIGINT AS long_text,
       count_if(lang = 'en')::BIGINT AS english, count_if(trim(coalesce(source, '')) = '')::BIGINT AS no_source, count_if(strpos(text, '@') > 0)::BIGINT AS with_at
FROM documents""")
def a02_coverage_counts(spark, sf) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf, "documents").agg(F.count("*").alias("n"), F.count_if(t != "").alias("with_text"), F.count_if(F.length(t) >= 1000).alias("long_text"), F.count_if(F.col("lang") == "en").alias("english"), F.count_if(F.trim(F.coalesce("source", F.lit(""))) == "").alias("no_source"), F.count_if(F.instr("text", "@") > 0).alias("with_at"))


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS total, count_if(o_orderstatus = 'F')::BIGINT AS ok, count_if(o_orderstatus = 'O')::BIGINT AS partial,
       count_if(o_orderstatus = 'P')::BIGINT AS failed, round(100.0 * count_if(o_orderstatus = 'F') / count(*), 2) AS ok_pct, round(avg(o_totalprice), 6) AS mean_engagement
FROM orders GROUP BY 1 ORDER BY 1 DESC""")
def a03_daily_monitor(spark, sf) -> DataFrame:
    s = F.col("o_orderstatus")
    n = lambda v: F.count_if(s == v)
    return table(spark, sf, "orders").groupBy(day_of().alias("day")).agg(F.count("*").alias("total"), n("F").alias("ok"), n("O").alias("partial"), n("P").alias("failed"), R.share(n("F"), F.count("*")).alias("ok_pct"), F.round(F.avg("o_totalprice"), 6).alias("mean_engagement")).orderBy(F.desc("day"))


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def a04_day_status(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").groupBy(day_of().alias("day"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d')), 2) AS pct
FROM orders GROUP BY 1, 2""")
def w05_status_share_by_day(spark, sf) -> DataFrame:
    return a04_day_status(spark, sf).withColumn("pct", R.share(F.col("n"), F.sum("n").over(Window.partitionBy("day"))))


@query("SELECT text, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def a05_duplicate_texts(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""
SELECT (SELECT count(*) FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)) AS duplicate_texts,
       (SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)) AS duplicate_ids""")
def a06_duplicate_key_count(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    n = lambda k, c: R.duplicated(d, [k]).agg(F.count("*").alias(c))
    return n("text", "duplicate_texts").crossJoin(n("doc_id", "duplicate_ids"))


@query("""
SELECT count(*) AS n, count(DISTINCT o_custkey) AS creators, count(DISTINCT o_orderkey) AS videos FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def a07_distinct_counts(spark, sf) -> DataFrame:
    w = table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz'1996-01-01' and o_orderdate < timestamp_ntz'1997-01-01'")
    return w.agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("creators"), F.count_distinct("o_orderkey").alias("videos"))


@query("SELECT count(*) AS n FROM (SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events)")
def a08_distinct_over_union(spark, sf) -> DataFrame:
    k = lambda t, c: table(spark, sf, t).select(F.col(c).alias("k"))
    return k("orders", "o_custkey").union(k("customer", "c_custkey")).union(k("events", "user_id")).distinct().agg(F.count("*").alias("n"))


@query("""
SELECT strftime(o.o_orderdate, '%Y-%m') AS month, count(DISTINCT o_orderkey) AS videos, round(sum(l_quantity) * 0.0015, 2) AS image_usd,
       round(sum(coalesce(l_extendedprice, 0)) / 60 * 0.006, 2) AS speech_usd, round(sum(l_quantity) * 0.0015 + sum(coalesce(l_extendedprice, 0)) / 60 * 0.006, 1) AS total_usd
FROM orders o JOIN lineitem l ON l_orderkey = o_orderkey GROUP BY 1""")
def a09_cost_rollup(spark, sf) -> DataFrame:
    o, li = table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    images, speech = F.sum("l_quantity") * 0.0015, F.sum(F.coalesce("l_extendedprice", F.lit(0.0))) / 60 * 0.006
    return o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count_distinct("o_orderkey").alias("videos"), F.round(images, 2).alias("image_usd"), F.round(speech, 2).alias("speech_usd"), F.round(images + speech, 1).alias("total_usd"))


@query("""
SELECT lang, count(*) AS n, round(avg(coalesce(quality, 0)), 4) AS mean_null_as_zero, round(avg(quality), 4) AS mean_null_skipped
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def a10_avg_null_modes(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("quality", F.lit(0))), 4).alias("mean_null_as_zero"), F.round(F.avg("quality"), 4).alias("mean_null_skipped"))


@query("""
SELECT user_id, count_if(event_type = 'error')::BIGINT AS errors, count_if(event_type = 'signup')::BIGINT AS signups,
       round(count_if(event_type = 'error') * 100.0 / nullif(count_if(event_type = 'signup'), 0), 2) AS errors_pct_of_signups
FROM events GROUP BY user_id""")
def a12_guarded_ratio(spark, sf) -> DataFrame:
    n = lambda v: F.count_if(F.col("event_type") == v)
    return table(spark, sf, "events").groupBy("user_id").agg(n("error").alias("errors"), n("signup").alias("signups"), R.share(n("error"), F.nullif(n("signup"), F.lit(0))).alias("errors_pct_of_signups"))


@query("""
SELECT coalesce(nullif(CASE WHEN event_type = 'error' THEN props ELSE '' END, ''), event_type) AS reason, count(*) AS n
FROM events GROUP BY 1 ORDER BY n DESC, reason LIMIT 25""")
def a13_failure_reasons_top(spark, sf) -> DataFrame:
    reason = R.first_filled(F.when(F.col("event_type") == "error", F.col("props")).otherwise(""), F.col("event_type"))
    return table(spark, sf, "events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(25)


@query("""
SELECT (CASE WHEN n_chars > 0 THEN 20 ELSE 0 END + CASE WHEN l.quality = 1 THEN 30 ELSE 0 END + CASE WHEN l.doc_id IS NOT NULL THEN 30 ELSE 0 END
        + CASE WHEN strpos(text, '#') > 0 THEN 10 ELSE 0 END + CASE WHEN strpos(text, '@') > 0 THEN 5 ELSE 0 END + CASE WHEN lang = 'en' THEN 5 ELSE 0 END)::INTEGER AS score, count(*) AS n
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def a14_score_histogram(spark, sf) -> DataFrame:
    from ..functions.score import enrichment_quality

    d = table(spark, sf, "documents").join(table(spark, sf, "labels").withColumn("labelled", F.lit(True)).drop("toxic"), "doc_id", "left")
    s = enrichment_quality(F.col("n_chars") > 0, F.col("quality") == 1, F.col("labelled"), F.instr("text", "#") > 0, F.instr("text", "@") > 0, F.col("lang") == "en")
    return d.groupBy(s.cast("int").alias("score")).agg(F.count("*").alias("n"))


def tokens():
    return F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{3,}"), F.lit(0))


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents WHERE lang = 'en')
GROUP BY word ORDER BY n DESC, word LIMIT 50""")
def a15_top_terms(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where("lang = 'en'").select(F.explode(tokens()).alias("word")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(50)


@query("""
WITH w AS (SELECT DISTINCT source, doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents),
c AS (SELECT source, word, count(*) AS n FROM w GROUP BY 1, 2)
SELECT source, word, n, rn::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS rn FROM c) WHERE rn <= 8""")
def a16_cooccurrence(spark, sf) -> DataFrame:
    w = table(spark, sf, "documents").select("source", F.explode(F.array_distinct(tokens())).alias("word"))
    return R.top_per_group(w.groupBy("source", "word").agg(F.count("*").alias("n")), ["source"], [F.desc("n"), F.asc("word")], 8, "rank")


@query("""
SELECT c_custkey AS username, coalesce(n, 0) AS videos, coalesce(done, 0) AS news
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count_if(o_orderstatus = 'F')::BIGINT AS done FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def a17_rollup_with_default(spark, sf) -> DataFrame:
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("username")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("username"))
    return users.join(per, "username", "left").select("username", F.coalesce("n", F.lit(0)).alias("videos"), F.coalesce("done", F.lit(0)).alias("news"))


@query("""
SELECT 'orders' AS source_table, count(*) AS n, count_if(o_orderstatus = 'F')::BIGINT AS ok FROM orders
UNION ALL SELECT 'customer', count(*), count_if(c_acctbal > 0)::BIGINT FROM customer
UNION ALL SELECT 'events', count(*), count_if(event_type <> 'error')::BIGINT FROM events""")
def a18_inventory_union(spark, sf) -> DataFrame:
    part = lambda t, ok: table(spark, sf, t).agg(F.count("*").alias("n"), F.count_if(F.expr(ok)).alias("ok")).select(F.lit(t).alias("source_table"), "n", "ok")
    return part("orders", "o_orderstatus = 'F'").unionByName(part("customer", "c_acctbal > 0")).unionByName(part("events", "event_type <> 'error'"))


@query("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS all_text, count(*) AS turns FROM conversations GROUP BY conv_id""")
def a19_text_concat_per_key(spark, sf) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("turn", "text")))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(listed["text"], " ").alias("all_text"), F.count("*").alias("turns"))


@query("""
SELECT conv_id, '[' || string_agg('{"turn":' || turn || ',"role":' || to_json(role) || ',"n":' || length(text) || '}', ',' ORDER BY turn, role, length(text)) || ']' AS thread
FROM conversations GROUP BY conv_id""")
def a20_thread_json(spark, sf) -> DataFrame:
    one = F.struct("turn", "role", F.length("text").alias("n"))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.to_json(F.sort_array(F.collect_list(one))).alias("thread"))


@query("""
WITH g AS (SELECT l_orderkey, l_returnflag AS glyph, sum(l_quantity)::BIGINT AS n, min(l_linenumber) AS first_at FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey AS video_id, string_agg(glyph, ' | ' ORDER BY n DESC, glyph) AS characters, string_agg(n::VARCHAR, ' | ' ORDER BY n DESC, glyph) AS counts, sum(n)::BIGINT AS total
FROM g GROUP BY 1""")
def a21_weighted_rollup(spark, sf) -> DataFrame:
    g = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("video_id"), F.col("l_returnflag").alias("glyph")).agg(F.sum("l_quantity").cast("long").alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "glyph")))
    return g.groupBy("video_id").agg(F.array_join(ordered["glyph"], " | ").alias("characters"), F.array_join(F.transform(ordered["m"], lambda m: (-m).cast("string")), " | ").alias("counts"), F.sum("n").alias("total"))


@query("""
SELECT user_id, count(*) AS n, round(avg(value), 4) AS mean_confidence, round(sum(CASE WHEN event_type = 'view' THEN value END) / nullif(count_if(event_type = 'view'), 0), 4) AS mean_view
FROM events GROUP BY user_id""")
def a23_mean_null_skip(spark, sf) -> DataFrame:
    view = F.when(F.col("event_type") == "view", F.col("value"))
    return table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_confidence"), F.round(F.avg(view), 4).alias("mean_view"))


@query("""
WITH s AS (SELECT source, lang, sum(n_chars)::BIGINT AS w, min(doc_id) AS first_at FROM documents GROUP BY 1, 2)
SELECT source, lang, w AS weight FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY w DESC, first_at) AS rn FROM s) WHERE rn = 1""")
def a24_dominant_language(spark, sf) -> DataFrame:
    s = table(spark, sf, "documents").groupBy("source", "lang").agg(F.sum("n_chars").alias("weight"), F.min("doc_id").alias("at"))
    return s.groupBy("source").agg(F.max_by(F.struct("lang", "weight"), F.struct("weight", (-F.col("at")).alias("at"))).alias("s")).select("source", "s.lang", "s.weight")


@query("""
WITH c AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, min(o_orderkey) AS first_at FROM orders GROUP BY 1, 2)
SELECT o_custkey, month, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first_at) AS rn FROM c) WHERE rn = 1""")
def a25_mode_date(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    return R.mode_first_seen(o, ["o_custkey"], "month", "o_orderkey")


@query("""
SELECT event_type AS worker, count(*) AS runs, count(DISTINCT user_id) AS entities, round(avg(value), 2) AS mean_elapsed, round(max(value), 2) AS max_elapsed,
       round(sum(value) / 60 * 0.006, 4) AS cost_usd, round(100.0 * count(*) / (SELECT count(*) FROM events), 1) AS share_pct
FROM events GROUP BY 1""")
def a26_run_metrics(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    m = e.groupBy(F.col("event_type").alias("worker")).agg(F.count("*").alias("runs"), F.count_distinct("user_id").alias("entities"), F.round(F.avg("value"), 2).alias("mean_elapsed"), F.round(F.max("value"), 2).alias("max_elapsed"), F.round(F.sum("value") / 60 * 0.006, 4).alias("cost_usd"))
    return m.crossJoin(e.agg(F.count("*").alias("all_runs"))).withColumn("share_pct", R.share(F.col("runs"), F.col("all_runs"), 1)).drop("all_runs")


@query("""
SELECT o_orderpriority AS pipeline, count(*) AS rows_in, count(DISTINCT o_orderkey) AS ids, count_if(o_orderstatus = 'F')::BIGINT AS complete,
       count_if(c_custkey IS NULL)::BIGINT AS orphans, count_if(o_totalprice IS NULL OR o_totalprice <= 0)::BIGINT AS no_metric
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def a27_pipeline_validation(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return o.groupBy(F.col("o_orderpriority").alias("pipeline")).agg(F.count("*").alias("rows_in"), F.count_distinct("o_orderkey").alias("ids"), F.count_if(F.col("o_orderstatus") == "F").alias("complete"), F.count_if(F.col("c_custkey").isNull()).alias("orphans"), F.count_if(F.col("o_totalprice").isNull() | (F.col("o_totalprice") <= 0)).alias("no_metric"))


@query("""
WITH c AS (
  SELECT user_id, event_id, ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AS inside, user_id % 7 = 0 AS excluded,
         row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts, event_id) > 1 AS again FROM events)
SELECT user_id, count(*) AS api_rows, count_if(NOT inside)::BIGINT AS outside, count_if(inside AND excluded)::BIGINT AS excluded,
       count_if(inside AND NOT excluded AND again)::BIGINT AS duplicates, count_if(inside AND NOT excluded AND NOT again)::BIGINT AS new_rows FROM c GROUP BY user_id""")
def a28_collection_counters(spark, sf) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type", "props").orderBy("ts", "event_id")
    c = table(spark, sf, "events").select("user_id", F.expr("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'").alias("i"), (F.col("user_id") % 7 == 0).alias("x"), (F.row_number().over(w) > 1).alias("a"))
    n = lambda e, c: F.count_if(F.expr(e)).alias(c)
    return c.groupBy("user_id").agg(F.count("*").alias("api_rows"), n("not i", "outside"), n("i and x", "excluded"), n("i and not x and a", "duplicates"), n("i and not x and not a", "new_rows"))


@query("""
SELECT count(*) AS total_rows, count_if(o_orderstatus <> 'P')::BIGINT AS video_rows, count_if(o_orderstatus = 'P')::BIGINT AS failed_rows,
       count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS failed_handles FROM orders""")
def a29_file_summary(spark, sf) -> DataFrame:
    bad = F.col("o_orderstatus") == "P"
    return table(spark, sf, "orders").agg(F.count("*").alias("total_rows"), F.count_if(~bad).alias("video_rows"), F.count_if(bad).alias("failed_rows"), F.count_distinct(F.when(bad, F.col("o_custkey"))).alias("failed_handles"))


@query("""
WITH m AS (SELECT 'before' AS side, * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' UNION ALL SELECT 'after', * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
r AS (SELECT round(100.0 * count_if(side = 'before' AND o_orderstatus = 'F') / nullif(count_if(side = 'before'), 0), 2) AS ok_before,
             round(100.0 * count_if(side = 'after' AND o_orderstatus = 'F') / nullif(count_if(side = 'after'), 0), 2) AS ok_after FROM m)
SELECT ok_before, ok_after, round(ok_after - ok_before, 2) AS delta, ok_after >= 98.0 AS target_met FROM r""")
def a31_delta_report(spark, sf) -> DataFrame:
    before, ok = F.expr("o_orderdate < timestamp_ntz'1998-01-01'"), F.col("o_orderstatus") == "F"
    pct = lambda side, c: R.share(F.count_if(side & ok), F.count_if(side)).alias(c)
    r = table(spark, sf, "orders").agg(pct(before, "ok_before"), pct(~before, "ok_after"))
    return r.select("*", F.round(F.col("ok_after") - F.col("ok_before"), 2).alias("delta"), (F.col("ok_after") >= 98.0).alias("target_met"))


@query("""
WITH b AS (SELECT o_orderkey // 1000 AS batch, count(*) AS n, count_if(o_orderstatus = 'P')::BIGINT AS bad FROM orders GROUP BY 1)
SELECT count(*) AS batches, sum(n)::BIGINT AS rows_in, sum(bad)::BIGINT AS failed, max(n) AS largest FROM b""")
def a32_batch_totals(spark, sf) -> DataFrame:
    b = table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("batch")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("bad"))
    return b.agg(F.count("*").alias("batches"), F.sum("n").alias("rows_in"), F.sum("bad").alias("failed"), F.max("n").alias("largest"))


@query("""
SELECT user_id, event_type AS stage, count(*) AS attempts, count(DISTINCT props) AS kinds, arg_max(props, event_id) AS latest,
       string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids FROM events GROUP BY 1, 2""")
def a34_attempts_per_stage(spark, sf) -> DataFrame:
    ids = F.sort_array(F.collect_list("event_id"))
    return table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("stage")).agg(F.count("*").alias("attempts"), F.count_distinct("props").alias("kinds"), F.max_by("props", "event_id").alias("latest"), F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@query("""
SELECT count(DISTINCT split_part(k, '|', 1)) AS failed_entities, count(DISTINCT k) AS failed_units
FROM (SELECT user_id || '|' || strftime(ts, '%Y-%m-%d') AS k FROM events WHERE event_type = 'error')""")
def a35_unique_failed_entities(spark, sf) -> DataFrame:
    k = F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf, "events").where("event_type = 'error'").select(k.alias("k")).agg(F.count_distinct(F.substring_index("k", "|", 1)).alias("failed_entities"), F.count_distinct("k").alias("failed_units"))
