"""What tables hold after upserts, merges and backfills; progress and late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import upserts as U
from ..registry import query
from ..session import table


def docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


@query("""
SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'xx' AS lang, 'labels' AS source, sum(quality)::BIGINT FROM labels GROUP BY doc_id""")
def k02_upsert_result(spark, sf) -> DataFrame:
    new = table(spark, sf, "labels").select("doc_id", F.lit("xx").alias("lang"), F.lit("labels").alias("source"), F.col("quality").cast("long").alias("n_chars"))
    return U.replace_by_key(docs(spark, sf), new, "doc_id", [F.desc("n_chars")])


@query("""
SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT conv_id, arg_min(role, turn) FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY 1""")
def k05_skip_existing_keys(spark, sf) -> DataFrame:
    new = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("lang"), "turn")
    return U.insert_missing(docs(spark, sf).where("lang = 'en'").select("doc_id", "lang"), new, "doc_id", [F.asc("turn"), F.asc("lang")]).drop("turn")


@query("""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END AS lang, source FROM documents WHERE doc_id % 5 <> 0),
r AS (SELECT doc_id, 'label' || quality AS lang, 'labels' AS source FROM labels)
SELECT coalesce(t.doc_id, r.doc_id) AS doc_id, coalesce(nullif(t.lang, ''), nullif(r.lang, ''), t.lang) AS lang, CASE WHEN t.doc_id IS NOT NULL THEN t.source ELSE r.source END AS source
FROM t FULL OUTER JOIN r ON t.doc_id = r.doc_id""")
def k07_fill_if_empty(spark, sf) -> DataFrame:
    t = docs(spark, sf).where("doc_id % 5 <> 0").select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 2 THEN lang END").alias("lang"), "source")
    r = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("label"), F.col("quality").cast("string")).alias("lang"), F.lit("labels").alias("source"))
    return U.fill_empty(t, r, "doc_id", ["lang"])


@query("""
WITH t AS (SELECT doc_id, n_chars AS likes, CASE WHEN doc_id % 2 = 0 THEN 'pipeline_1' ELSE 'pipeline_3' END AS pipeline_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'voice' END AS voice, [source] AS kw FROM documents WHERE doc_id % 3 <> 0),
r AS (SELECT doc_id, n_chars + 1 AS likes, 'keyword' AS pipeline_id, 'new voice' AS voice, [lang, source] AS kw FROM documents WHERE doc_id % 2 = 0 OR doc_id % 5 = 0)
SELECT coalesce(t.doc_id, r.doc_id) AS doc_id, coalesce(r.likes, t.likes) AS likes,
       CASE WHEN t.doc_id IS NOT NULL AND (t.pipeline_id = 'pipeline_1' OR r.doc_id IS NULL) THEN t.pipeline_id ELSE r.pipeline_id END AS pipeline_id,
       CASE WHEN t.doc_id IS NOT NULL THEN coalesce(nullif(t.voice, ''), nullif(r.voice, '')) ELSE r.voice END AS voice,
       CASE WHEN t.doc_id IS NULL THEN array_to_string(r.kw, '|') WHEN r.doc_id IS NULL THEN array_to_string(t.kw, '|') ELSE t.kw[1] || '|' || r.kw[1] END AS keywords
FROM t FULL OUTER JOIN r ON t.doc_id = r.doc_id""")
def k08_provenance_merge(spark, sf) -> DataFrame:
    d = docs(spark, sf)
    t = d.where("doc_id % 3 <> 0").select("doc_id", F.col("n_chars").alias("likes"), F.expr("if(doc_id % 2 = 0, 'pipeline_1', 'pipeline_3')").alias("pipeline_id"), F.expr("if(doc_id % 4 = 0, '', 'voice')").alias("voice"), F.array("source").alias("kw"))
    r = d.where("doc_id % 2 = 0 or doc_id % 5 = 0").select("doc_id", (F.col("n_chars") + 1).alias("likes"), F.lit("keyword").alias("pipeline_id"), F.lit("new voice").alias("voice"), F.array("lang", "source").alias("kw"))
    m = U.merge_with_provenance(t, r, "doc_id", F.col("t.pipeline_id") == "pipeline_1", ["pipeline_id"], ["likes"], ["voice"], "kw")
    return m.select("doc_id", "likes", "pipeline_id", "voice", F.array_join("kw", "|").alias("keywords"))


@query("""
SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations) WHERE rn = 1""")
def k10_first_wins(spark, sf) -> DataFrame:
    return R.row_one(table(spark, sf, "conversations"), ["conv_id"], [F.asc("turn"), F.asc("role"), F.asc("text")]).select("conv_id", "turn", "role")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT o_orderkey, 0, o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def k11_replace_children(spark, sf) -> DataFrame:
    new = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), F.col("o_totalprice").alias("l_quantity"))
    return U.replace_children(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), new, "l_orderkey")


@query("""
WITH t AS (SELECT c_custkey AS k, NULL::VARCHAR AS started, c_name AS completed FROM customer), r AS (SELECT s_suppkey AS k, s_name AS started, CASE WHEN s_suppkey % 2 = 0 THEN 'done' END AS completed FROM supplier)
SELECT coalesce(t.k, r.k) AS k, coalesce(r.started, t.started) AS started, coalesce(r.completed, t.completed) AS completed FROM t FULL OUTER JOIN r ON t.k = r.k""")
def k12_sparse_update(spark, sf) -> DataFrame:
    t = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit(None).cast("string").alias("started"), F.col("c_name").alias("completed"))
    r = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("started"), F.expr("CASE WHEN s_suppkey % 2 = 0 THEN 'done' END").alias("completed"))
    return U.sparse_update(t, r, "k", ["started", "completed"])


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 0.0 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_totalprice < 50000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def k13_conditional_update(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    small = F.col("o_totalprice") < 50000
    return o.select("o_orderkey", F.when(small, 0.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"), F.when(small, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))


@query("""
SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' END, ''), nullif(source, '')) AS filled, coalesce(CASE WHEN doc_id % 3 = 0 THEN n_chars END, doc_id) AS n,
       CASE WHEN doc_id % 4 = 0 AND NOT starts_with(source, 'src1') THEN 'ok' ELSE lang END AS status FROM documents""")
def k14_backfill(spark, sf) -> DataFrame:
    new = F.expr("CASE WHEN doc_id % 2 = 0 THEN '' END")
    return docs(spark, sf).select("doc_id", R.first_filled(new, F.col("source")).alias("filled"), F.coalesce(F.expr("CASE WHEN doc_id % 3 = 0 THEN n_chars END"), "doc_id").alias("n"), F.when((F.col("doc_id") % 4 == 0) & ~F.col("source").startswith("src1"), "ok").otherwise(F.col("lang")).alias("status"))


@query("""
SELECT 'handle_fail:' || strftime(ts, '%Y-%m-%d') || ':' || user_id AS video_id, 'api_failed' AS collection_status, 0 AS likes, min(props) AS reason, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY 1""")
def k04_failure_stubs(spark, sf) -> DataFrame:
    vid = F.concat_ws(":", F.lit("handle_fail"), F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"))
    return table(spark, sf, "events").where("event_type = 'error'").groupBy(vid.alias("video_id")).agg(F.min("props").alias("reason"), F.count("*").alias("failures")).select("video_id", F.lit("api_failed").alias("collection_status"), F.lit(0).alias("likes"), "reason", "failures")


@query("""
WITH ok AS (SELECT count(*) AS n, count_if(lang IS NULL)::BIGINT AS no_lang, count(DISTINCT doc_id) AS ids FROM documents) SELECT n, no_lang, n = ids AS unique_ids, n > 0 AND no_lang = 0 AND n = ids AS accepted FROM ok""")
def k24_upload_gate(spark, sf) -> DataFrame:
    a = docs(spark, sf).agg(F.count("*").alias("n"), F.count_if(F.col("lang").isNull()).alias("no_lang"), F.count_distinct("doc_id").alias("ids"))
    return a.select("n", "no_lang", (F.col("n") == F.col("ids")).alias("unique_ids"), ((F.col("n") > 0) & (F.col("no_lang") == 0) & (F.col("n") == F.col("ids"))).alias("accepted"))


@query("""
WITH u AS (SELECT c.c_custkey AS entity, d.day FROM customer c, (VALUES ('2024-01-01'), ('2024-01-02'), ('2024-01-03')) d(day))
SELECT entity, day, entity || '|' || day AS key FROM u WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = entity AND strftime(ts, '%Y-%m-%d') = day AND event_type <> 'error')""")
def st1_pending_units(spark, sf) -> DataFrame:
    days = F.explode(F.array(*[F.lit(f"2024-01-0{i}") for i in (1, 2, 3)]))
    units = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), days.alias("day"))
    done = table(spark, sf, "events").where("event_type <> 'error'").select(F.col("user_id").alias("entity"), F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    return units.join(done, ["entity", "day"], "left_anti").withColumn("key", F.concat_ws("|", F.col("entity").cast("string"), "day"))


@query("""
SELECT user_id AS entity, CASE WHEN bool_or(event_type = 'purchase') THEN 'completed' WHEN bool_or(event_type = 'error') AND bool_or(event_type <> 'error') THEN 'partial' WHEN bool_or(event_type = 'error') THEN 'failed' ELSE 'pending' END AS state,
       max(event_id) AS cursor, count(*) AS pages FROM events GROUP BY user_id""")
def st2_progress_state(spark, sf) -> DataFrame:
    t = F.col("event_type")
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("entity"))
    state = F.when(F.bool_or(t == "purchase"), "completed").when(F.bool_or(t == "error") & F.bool_or(t != "error"), "partial").when(F.bool_or(t == "error"), "failed").otherwise("pending")
    return e.agg(state.alias("state"), F.max("event_id").alias("cursor"), F.count("*").alias("pages"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS arrived, count_if(ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20')::BIGINT AS kept,
       count_if(NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'))::BIGINT AS late FROM events GROUP BY 1""")
def st3_late_rows(spark, sf) -> DataFrame:
    inside = F.expr("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'")
    return table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("arrived"), F.count_if(inside).alias("kept"), F.count_if(~inside).alias("late"))


@query("""
SELECT user_id, props AS video, string_agg(event_type, '|' ORDER BY first_at, event_type) AS keywords, sum(n)::BIGINT AS hits
FROM (SELECT user_id, props, event_type, min(event_id) AS first_at, count(*) AS n FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def st4_merge_keywords(spark, sf) -> DataFrame:
    each = table(spark, sf, "events").groupBy("user_id", F.col("props").alias("video"), "event_type").agg(F.min("event_id").alias("first_at"), F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct("first_at", "event_type")))
    return each.groupBy("user_id", "video").agg(F.array_join(listed["event_type"], "|").alias("keywords"), F.sum("n").alias("hits"))


@query("""
WITH c AS (SELECT 'missing_text' AS check_name, 'error' AS severity, count_if(coalesce(trim(text), '') = '')::BIGINT AS bad, count(*) AS n FROM documents
UNION ALL SELECT 'duplicate_ids', 'error', count(*) - count(DISTINCT doc_id), count(*) FROM documents
UNION ALL SELECT 'orphan_labels', 'warning', count_if(d.doc_id IS NULL)::BIGINT, count(*) FROM labels l LEFT JOIN documents d USING (doc_id)
UNION ALL SELECT 'bad_timestamps', 'error', count_if(ts IS NULL OR ts < TIMESTAMP '2024-01-01')::BIGINT, count(*) FROM events
UNION ALL SELECT 'latency_coverage', 'warning', count_if(value IS NULL)::BIGINT, count(*) FROM events
UNION ALL SELECT 'duplicate_texts', 'warning', count(*) - count(DISTINCT text), count(*) FROM documents)
SELECT check_name, severity, bad, n, bad = 0 AS ok, round(100.0 * bad / nullif(n, 0), 2) AS bad_pct FROM c""")
def q01_data_quality_suite(spark, sf) -> DataFrame:
    def check(df, name, severity, bad):
        return df.agg(bad.cast("long").alias("bad"), F.count("*").alias("n")).select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "bad", "n")

    d, e = table(spark, sf, "documents"), table(spark, sf, "events")
    lab = table(spark, sf, "labels").join(d.select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
    parts = [
        check(d, "missing_text", "error", F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "")),
        check(d, "duplicate_ids", "error", F.count("*") - F.count_distinct("doc_id")),
        check(lab, "orphan_labels", "warning", F.count_if(F.col("known").isNull())),
        check(e, "bad_timestamps", "error", F.count_if(F.expr("ts is null or ts < timestamp_ntz'2024-01-01'"))),
        check(e, "latency_coverage", "warning", F.count_if(F.col("value").isNull())),
        check(d, "duplicate_texts", "warning", F.count("*") - F.count_distinct("text")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("*", (F.col("bad") == 0).alias("ok"), R.share(F.col("bad"), F.nullif("n", F.lit(0))).alias("bad_pct"))


@query("""
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def e01_hourly_windows(spark, sf) -> DataFrame:
    """Tumbling windows over the log (an extension)."""
    w = table(spark, sf, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", "total")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS began, count(*) AS n FROM s GROUP BY user_id, id""")
def e02_sessions(spark, sf) -> DataFrame:
    """Sessions with a gap of six hours (an extension)."""
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = e.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.min("ts").alias("b"), F.count("*").alias("n"))
    return s.select("user_id", F.date_format("b", "yyyy-MM-dd HH:mm:ss").alias("began"), "n")


@query("""
SELECT event_id, user_id, (SELECT max(o_orderkey) FROM orders WHERE o_custkey = user_id AND o_orderkey <= event_id) AS last_order FROM events""")
def e03_as_of_lookup(spark, sf) -> DataFrame:
    """The newest order key of the user up to each event, by a union and one window (an extension)."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("k"), "user_id", F.lit(None).cast("long").alias("o"), F.lit(1).alias("side"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("o"), F.lit(0).alias("side"))
    w = Window.partitionBy("user_id").orderBy("k", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return e.unionByName(o).withColumn("last_order", F.last("o", ignorenulls=True).over(w)).where("side = 1").select(F.col("k").alias("event_id"), "user_id", "last_order")
