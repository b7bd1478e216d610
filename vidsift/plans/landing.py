"""Sources and sinks as queries: rows are written the way they land, then read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import relational as R
from ..operators import upserts as U
from ..registry import query
from ..session import table
from ..sources import landed as L
from ..sources import readers, writers


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s01_table_scan(spark, sf) -> DataFrame:
    return table(spark, sf, "nation")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def s02_projected_scan(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def s03_parameterised_scan(spark, sf) -> DataFrame:
    sql = "SELECT o_orderkey, o_orderstatus FROM {o} WHERE o_orderstatus = :status AND array_contains(:priorities, o_orderpriority)"
    return spark.sql(sql, args={"status": "F", "priorities": F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))}, o=table(spark, sf, "orders"))


@query("""
WITH l AS (SELECT lower(replace(s_name, '#', '')) AS value, min(s_suppkey) AS first_at FROM supplier WHERE s_suppkey % 7 <> 0 GROUP BY 1)
SELECT (row_number() OVER (ORDER BY first_at) - 1)::INTEGER AS place, value FROM l""")
def s04_handle_list(spark, sf) -> DataFrame:
    """A text list with comments, @ and blank lines."""
    name = F.replace("s_name", F.lit("#"), F.lit(""))
    line = F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("# "), name)).otherwise(F.concat(F.lit(" @"), name, F.lit("  ")))
    path = L.workspace(spark, "handles.txt")
    table(spark, sf, "supplier").orderBy("s_suppkey").coalesce(1).select(F.concat_ws("\n", line, F.lit("")).alias("value")).write.text(path)
    return readers.listed(spark, path)


@query("""SELECT (row_number() OVER (ORDER BY first_at) - 1)::INTEGER AS place, value FROM (SELECT lower(p_type) AS value, min(p_partkey) AS first_at FROM part GROUP BY 1)""")
def s05_keyword_csv(spark, sf) -> DataFrame:
    path = L.workspace(spark, "keywords.csv")
    table(spark, sf, "part").orderBy("p_partkey").coalesce(1).select("p_partkey", F.upper("p_type").alias("term")).write.csv(path, header=True)
    return readers.keywords(spark, path)


@query("""SELECT s_name AS outlet, s_nationkey::VARCHAR AS usable, NULL::VARCHAR AS absent FROM supplier""")
def s06_loose_headers(spark, sf) -> DataFrame:
    path = L.workspace(spark, "loose")
    table(spark, sf, "supplier").select(F.col("s_name").alias(" Outlet   Name"), F.col("s_nationkey").alias("Usable (human review)")).write.csv(path, header=True)
    return readers.loose_csv(spark, path, {"outlet": "outlet name", "usable": "usable", "absent": "none"})


@query("SELECT o_orderkey::VARCHAR AS video_id, strftime(o_orderdate, '%Y-%m-%d') AS collection_date, o_custkey AS like_count FROM orders")
def s07_dated_csv(spark, sf) -> DataFrame:
    path = L.workspace(spark, "day")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("video_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("collection_date"), F.col("o_custkey").alias("like_count"))
    o.unionByName(o.limit(3).select(*[F.lit(None).cast("string").alias(c) for c in o.columns])).write.csv(path, header=True)
    return readers.dated_csv(spark, path, StructType.fromDDL("video_id string, collection_date string, like_count long"))


def _items(spark, sf) -> DataFrame:
    """Documents as videos that were landed page by page, the second page twice."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("username"), F.array_distinct(F.split("text", " ")).alias("keywords"), "text", F.col("doc_id").alias("at"))
    path = L.workspace(spark, "pages")
    L.land(d, f"{path}/a", F.lit("s1"))
    L.land(d.where("at between 100 and 199"), f"{path}/b", F.lit("s1"))
    return L.items(spark, f"{path}/*")


@query("SELECT doc_id::VARCHAR AS id, source AS username FROM documents WHERE source = (SELECT min(source) FROM documents)")
def s08_landed_by_username(spark, sf) -> DataFrame:
    least = table(spark, sf, "documents").agg(F.min("source").alias("username"))
    return _items(spark, sf).join(F.broadcast(least), "username").select("id", "username")  # one row


@query(r"""SELECT doc_id::VARCHAR AS id FROM documents WHERE len(list_filter(string_split(text, ' '), lambda x: x IN ('the', 'The', 'and', 'de'))) > 0""")
def s09_landed_by_keywords(spark, sf) -> DataFrame:
    return _items(spark, sf).where(F.arrays_overlap("keywords", F.array(*map(F.lit, ("the", "The", "and", "de"))))).select("id")


@query(r"""SELECT doc_id::VARCHAR AS id FROM documents WHERE len(list_filter(string_split(text, ' '), lambda x: x IN ('the', 'The', 'and', 'de'))) > 0 AND strpos(text, ',') > 0""")
def s10_landed_by_keyword_and_tag(spark, sf) -> DataFrame:
    return _items(spark, sf).where(F.arrays_overlap("keywords", F.array(*map(F.lit, ("the", "The", "and", "de")))) & (F.instr("text", ",") > 0)).select("id")


@query("SELECT user_id, arg_max(event_id, {'ts': ts, 'id': event_id}) AS event_id, strftime(max(ts), '%Y-%m') AS month FROM events WHERE event_type = 'error' GROUP BY 1")
def s11_newest_hit(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").where("event_type = 'error'")
    return e.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.date_format(F.max("ts"), "yyyy-MM").alias("month"))


@query("SELECT conv_id AS video_id, turn AS comment_id, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn FROM conversations) WHERE rn <= 3")
def s12_comments_capped(spark, sf) -> DataFrame:
    """At most three comments a video: the cap is the feature."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("comment_id"), "text")
    path = L.workspace(spark, "comments")
    c.write.json(path)
    return R.top_per_group(spark.read.schema("video_id long, comment_id long, text string").json(path), ["video_id"], [F.asc("comment_id"), F.asc("text")], 3)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def s16_id_list(spark, sf) -> DataFrame:
    ids = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return readers.by_ids(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ids, "o_orderkey")


@query("SELECT event_type AS endpoint, (200 + event_id % 3 * 100)::INTEGER AS http_status, event_id::VARCHAR AS handle, NOT event_id % 10 = 0 AS whole FROM events")
def s17_raw_lines(spark, sf) -> DataFrame:
    """One JSON line a call; every tenth lost its tail, which the reader keeps apart."""
    e = table(spark, sf, "events").select(F.to_json(F.struct(F.col("event_type").alias("endpoint"), (200 + F.col("event_id") % 3 * 100).cast("int").alias("http_status"), F.col("event_id").cast("string").alias("handle"))).alias("j"), "event_id")
    path = L.workspace(spark, "raw")
    e.select(F.when(F.col("event_id") % 10 == 0, F.regexp_replace("j", r"\}$", "")).otherwise(F.col("j"))).write.text(path)
    raw = readers.raw_responses(spark, path)
    part = lambda c: F.coalesce(F.col(c), F.regexp_extract("_corrupt_record", rf'"{c}":"?([^",}}]+)', 1).try_cast(dict(raw.dtypes)[c]))
    return raw.select(*[part(c).alias(c) for c in ("endpoint", "http_status", "handle")], F.col("_corrupt_record").isNull().alias("whole"))


@query("SELECT o_orderkey AS video, o_orderpriority AS priority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def s18_analysis_file(spark, sf) -> DataFrame:
    path = L.workspace(spark, "analysis")
    row = F.struct(F.col("o_orderkey").alias("video"), F.col("o_orderpriority").alias("priority"))
    files = table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / 10_000).alias("p")).agg(F.to_json(F.collect_list(row)).alias("value"))  # a list of bounded length a file
    files.write.partitionBy("p").text(path)
    return readers.analysis_rows(spark, path, "1-URGENT", "2-HIGH").select("video", "priority")


@query("SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'partial' END AS kind, o_custkey::VARCHAR AS key FROM orders")
def s19_checkpoint_sets(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("partial").alias("kind"), F.col("o_custkey").cast("string").alias("key"))
    path = L.workspace(spark, "state")
    per = o.groupBy(F.floor(F.col("key").cast("long") / 10_000).alias("p")).agg(*[F.collect_set(F.when(F.col("kind") == k, F.col("key"))).alias(k) for k in ("completed", "failed", "partial")])
    per.write.partitionBy("p").json(path)  # one state of bounded size a file
    return L.checkpoint_sets(spark, path)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def s20_newest_file(spark, sf) -> DataFrame:
    path = L.workspace(spark, "runs")
    n = table(spark, sf, "nation").coalesce(1)
    for i in range(3):
        n.where(F.col("n_regionkey") == i).select("n_nationkey", "n_name").write.mode("append").json(path)
    return spark.read.schema("n_nationkey int, n_name string").json(readers.newest(spark, path, "part-*.json"))


@query("SELECT doc_id::VARCHAR AS liked FROM documents WHERE doc_id % 2 = 0")
def s21_liked_pages(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("id"), F.lit("me").alias("username"), F.array().cast("array<string>").alias("keywords"), F.lit("").alias("text"), F.col("doc_id").alias("at"))
    path = L.workspace(spark, "liked")
    L.land(d, path, F.col("username"), per_page=30)
    return L.items(spark, path).select(F.col("id").alias("liked"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' AND value > 100 THEN 'unknown' WHEN event_type = 'error' THEN 'invalid' ELSE 'valid' END AS state,
       CASE WHEN event_type = 'error' AND value > 100 THEN 'rate limited' WHEN event_type = 'error' AND value > 50 THEN 'not found' WHEN event_type = 'error' THEN 'private' ELSE '' END AS reason FROM events""")
def s22_handle_validation(spark, sf) -> DataFrame:
    failed, v = F.col("event_type") == "error", F.col("value")
    code = F.when(failed & (v > 100), 429).when(failed & (v > 50), 404).when(failed, 403).otherwise(200)
    e = table(spark, sf, "events").select("event_id", code.alias("code"))
    c = F.col("code")
    return e.select("event_id", F.when(c == 200, "valid").when(c.isin(403, 404), "invalid").otherwise("unknown").alias("state"), F.when(c == 429, "rate limited").when(c == 404, "not found").when(c == 403, "private").otherwise("").alias("reason"))


@query(r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS author,
       array_to_string(list_transform(regexp_extract_all(html, '<a href="/[^"]*">[^<]*</a>'), lambda x: regexp_extract(x, '>([^<]*)<', 1)), ' | ') AS stickers FROM pages""")
def s23_web_metadata(spark, sf) -> DataFrame:
    """Title, language, author and link texts of a page in one record."""
    links = F.regexp_extract_all("html", F.lit(r'<a href="/[^"]*">([^<]*)</a>'), F.lit(1))
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("author"), F.array_join(links, " | ").alias("stickers"))


@query("""
SELECT s.s_suppkey::VARCHAR AS username, CASE WHEN c_custkey IS NULL THEN 'not_found' WHEN c_acctbal < 0 THEN 'failed' ELSE 'found' END AS lookup,
       CASE WHEN c_acctbal >= 0 THEN c_name ELSE '' END AS display_name, CASE WHEN c_acctbal >= 0 THEN c_nationkey::VARCHAR ELSE '' END AS region FROM supplier s LEFT JOIN customer ON c_custkey = s_suppkey * 7""")
def s24_profile_lookup(spark, sf) -> DataFrame:
    """API data as JSON, typed, then flattened to text fields."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.to_json(F.struct("c_name", "c_nationkey", (F.col("c_acctbal") >= 0).alias("ok"))).alias("data"))
    d = table(spark, sf, "supplier").join(c, F.col("k") == F.col("s_suppkey") * 7, "left").withColumn("p", F.from_json("data", "c_name string, c_nationkey int, ok boolean"))
    shown = lambda f: F.when(F.col("p.ok"), F.col(f).cast("string")).otherwise("")
    return d.select(F.col("s_suppkey").cast("string").alias("username"), F.when(F.col("data").isNull(), "not_found").when(F.col("p.ok"), "found").otherwise("failed").alias("lookup"), shown("p.c_name").alias("display_name"), shown("p.c_nationkey").alias("region"))


@query("SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'error'")
def k01_append_load(spark, sf) -> DataFrame:
    path, e = L.workspace(spark, "log"), table(spark, sf, "events").select("event_id", "event_type")
    writers.append(e, path)
    writers.append(e.where("event_type = 'error'"), path)
    return spark.read.schema(e.schema).parquet(path)


@query("""
SELECT 'creators' AS store, c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS v FROM customer
UNION ALL SELECT 'news', s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE s_name END FROM supplier""")
def k03_upsert_per_pipeline(spark, sf) -> DataFrame:
    out = None
    for store, name, key, value in (("creators", "customer", "c_custkey", "c_name"), ("news", "supplier", "s_suppkey", "s_name")):
        path, d = L.workspace(spark, store), table(spark, sf, name).select(F.col(key).alias("k"), F.col(value).alias("v"))
        writers.upsert(d, path, "k", [F.asc("v")])
        writers.upsert(d.where("k % 2 = 0").withColumn("v", F.upper("v")), path, "k", [F.asc("v")])
        rows = spark.read.schema(d.schema).parquet(path).select(F.lit(store).alias("store"), "k", "v")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT part.p_partkey, p_name, p_size FROM part")
def k06_ndjson_load(spark, sf) -> DataFrame:
    path, d = L.workspace(spark, "ndjson"), table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    d.write.json(path)
    return spark.read.schema(d.schema).json(path)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'replaced' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def k09_insert_or_replace(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return U.replace_by_key(o, o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("replaced")), "o_orderkey", [F.asc("o_orderstatus")])


@query("SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def k16_rewrite_in_place(spark, sf) -> DataFrame:
    path, d = L.workspace(spark, "table"), table(spark, sf, "documents").select("doc_id", "text")
    writers.swap(d, path)
    held = spark.read.schema(d.schema).parquet(path)
    writers.swap(held.groupBy("text").agg(F.min("doc_id").alias("doc_id")), path)
    return spark.read.parquet(path)


@query("SELECT count(*)::BIGINT AS copied, 0::BIGINT AS left_over FROM customer")
def k17_backup_and_recreate(spark, sf) -> DataFrame:
    path = L.workspace(spark, "enriched")
    writers.swap(table(spark, sf, "customer"), path)
    copy = spark.read.parquet(writers.backed_up(spark, path)).agg(F.count("*").alias("copied"))
    return copy.crossJoin(spark.read.parquet(path).agg(F.count("*").alias("left_over")))  # one row each


@query("SELECT 'news' AS store, false AS there UNION ALL SELECT 'creators', true")
def k18_drop_tables(spark, sf) -> DataFrame:
    at = {n: L.workspace(spark, n) for n in ("news", "creators")}
    for p in at.values():
        writers.swap(table(spark, sf, "region"), p)
    writers.dropped(spark, at["news"], L.workspace(spark, "never"))
    return spark.createDataFrame([(n, writers.there(spark, p)) for n, p in at.items()], "store string, there boolean")


@query("SELECT c_custkey, c_name, NULL::VARCHAR AS bio, NULL::VARCHAR AS tags FROM customer")
def k19_add_columns(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return writers.widened(c, c_name="int", bio="string", tags="array<string>").withColumn("tags", F.array_join("tags", "|"))


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS collection_date, o_orderkey::VARCHAR AS video_id, o_custkey::VARCHAR AS username FROM orders WHERE o_orderstatus = 'F'")
def k21_collector_csv(spark, sf) -> DataFrame:
    path = L.workspace(spark, "collector")
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("video_id"), F.col("o_custkey").alias("username"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("collection_date"))
    writers.write_csv(o.orderBy("username", "video_id"), path, ["collection_date", "video_id"])
    return spark.read.csv(path, header=True)


@query("SELECT 'csv' AS kind, count(*)::BIGINT AS rows, 3 AS columns FROM orders UNION ALL SELECT 'parquet', count(*), 3 FROM orders")
def k22_export_with_manifest(spark, sf) -> DataFrame:
    path, o = L.workspace(spark, "export"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_csv(o, f"{path}/csv")
    o.write.parquet(f"{path}/parquet")
    back = {"csv": spark.read.csv(f"{path}/csv", header=True), "parquet": spark.read.parquet(f"{path}/parquet")}
    rows = [d.agg(F.lit(k).alias("kind"), F.count("*").alias("rows"), F.lit(len(d.columns)).alias("columns")) for k, d in back.items()]
    rows[0].unionByName(rows[1]).coalesce(1).write.json(f"{path}/manifest")
    return spark.read.schema("kind string, rows long, columns int").json(f"{path}/manifest")


@query("SELECT o_orderkey::VARCHAR AS video_id, c_name AS username, o_totalprice::VARCHAR AS views FROM orders JOIN customer ON c_custkey = o_custkey")
def k23_video_user_export(spark, sf) -> DataFrame:
    path, c = L.workspace(spark, "videos"), table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("username"))
    writers.write_csv(table(spark, sf, "orders").join(c, "o_custkey").select(F.col("o_orderkey").alias("video_id"), "username", F.col("o_totalprice").alias("views")), path)
    return spark.read.csv(path, header=True)


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM events GROUP BY 1")
def k25_dated_archive(spark, sf) -> DataFrame:
    """Every day is written twice; the second replaces the first."""
    path, e = L.workspace(spark, "archive"), table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("collection_date"))
    for _ in range(2):
        writers.dated(e, path)
    return spark.read.schema("event_id long, collection_date string").parquet(path).groupBy(F.col("collection_date").alias("day")).agg(F.count("*").alias("n"))


@query("""SELECT string_agg('| ' || event_type || ' | ' || n || ' |', chr(10) ORDER BY event_type) AS report FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""")
def k26_report(spark, sf) -> DataFrame:
    per = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    line = F.concat(F.lit("| "), "event_type", F.lit(" | "), F.col("n").cast("string"), F.lit(" |"))
    return per.agg(F.array_join(F.sort_array(F.collect_list(F.struct("event_type", line.alias("line"))))["line"], "\n").alias("report"))  # a row a type


@query("SELECT event_id, event_type FROM events UNION ALL SELECT event_id, 'again' FROM events WHERE event_type = 'view'")
def k27_raw_append(spark, sf) -> DataFrame:
    path, e = L.workspace(spark, "raw"), table(spark, sf, "events").select("event_id", "event_type")
    writers.append(e, path, "json")
    writers.append(e.where("event_type = 'view'").withColumn("event_type", F.lit("again")), path, "json")
    return spark.read.schema(e.schema).json(path)


@query("SELECT event_type, count(*)::BIGINT AS n FROM events WHERE value > 100 GROUP BY 1")
def k28_views(spark, sf) -> DataFrame:
    """A script of statements, one view each, the second over the first."""
    table(spark, sf, "events").createOrReplaceTempView("vidsift_log")
    script = "CREATE OR REPLACE TEMPORARY VIEW vidsift_large AS SELECT * FROM vidsift_log WHERE value > 100;\nCREATE OR REPLACE TEMPORARY VIEW vidsift_per_type AS SELECT event_type, count(*) AS n FROM vidsift_large GROUP BY 1;\n"
    for statement in filter(None, map(str.strip, script.split(";"))):
        spark.sql(statement)
    return spark.table("vidsift_per_type")


@query("SELECT 'validation' AS worker, 1 AS ok, count(*)::BIGINT AS rows, count(DISTINCT user_id)::BIGINT AS users FROM events")
def k29_validation_event(spark, sf) -> DataFrame:
    path = L.workspace(spark, "validation")
    writers.append(table(spark, sf, "events").agg(F.lit("validation").alias("worker"), F.lit(1).alias("ok"), F.count("*").alias("rows"), F.countDistinct("user_id").alias("users")), path)
    return spark.read.parquet(path)


@query("""SELECT event_id, event_type AS worker, (event_type <> 'error')::INTEGER AS ok, '{"user":' || user_id || ',"type":"' || event_type || '"}' AS detail_json FROM events""")
def k30_audit_rows(spark, sf) -> DataFrame:
    t = F.col("event_type")
    return table(spark, sf, "events").select("event_id", t.alias("worker"), (t != "error").cast("int").alias("ok"), F.to_json(F.struct(F.col("user_id").alias("user"), t.alias("type"))).alias("detail_json"))


@query("""
SELECT coalesce(o.k, n.k) AS k, coalesce(nullif(o.v, ''), n.v, o.v) AS v
FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS v FROM customer WHERE c_custkey % 5 <> 0) o FULL JOIN (SELECT c_custkey AS k, 'stub ' || c_custkey AS v FROM customer WHERE c_custkey % 2 = 0) n ON o.k = n.k""")
def k31_stub_or_fill(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    old = c.where("k % 5 <> 0").select("k", F.when(F.col("k") % 4 == 0, "").otherwise(F.col("c_name")).alias("v"))
    return U.fill_empty(old, c.where("k % 2 = 0").select("k", F.concat(F.lit("stub "), F.col("k").cast("string")).alias("v")), "k", ["v"])


@query("SELECT lower(replace(s_name, '#', '')) AS candidate, s_suppkey::VARCHAR AS pos, 'joined' AS evidence, '' AS note FROM supplier")
def k32_candidate_csv(spark, sf) -> DataFrame:
    path, s = L.workspace(spark, "candidates"), table(spark, sf, "supplier")
    made = s.select(F.lower(F.replace("s_name", F.lit("#"), F.lit(""))).alias("candidate"), F.col("s_suppkey").alias("pos"), F.lit("joined").alias("evidence"), F.lit(None).cast("string").alias("note"))
    writers.write_csv(made, path, ["candidate"])
    return spark.read.csv(path, header=True).fillna("")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'overlap' WHEN c_custkey % 2 = 0 THEN 'P1' WHEN c_custkey % 3 = 0 THEN 'P2' ELSE 'none' END AS class FROM customer""")
def p21_exclusion_class(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey")
    one, two = c.where("c_custkey % 2 = 0").withColumn("one", F.lit(True)), c.where("c_custkey % 3 = 0").withColumn("two", F.lit(True))
    a, b = F.col("one").isNotNull(), F.col("two").isNotNull()
    return c.join(one, "c_custkey", "left").join(two, "c_custkey", "left").select("c_custkey", F.when(a & b, "overlap").when(a, "P1").when(b, "P2").otherwise("none").alias("class"))


@query("SELECT 'dated' AS chosen, count(*)::BIGINT AS rows FROM nation")
def p28_usable_file(spark, sf) -> DataFrame:
    """Of several exports the first that has rows, dated ones first."""
    n, path = table(spark, sf, "nation"), L.workspace(spark, "exports")
    for name, d in (("dated_empty", n.limit(0)), ("dated", n), ("latest", n.where("n_nationkey < 5"))):
        d.write.csv(f"{path}/{name}", header=True)
    name, rows = readers.first_usable(spark, {k: f"{path}/{k}" for k in ("dated_empty", "dated", "latest")})
    return spark.createDataFrame([(name, rows)], "chosen string, rows long")


@query("SELECT o_orderkey::VARCHAR AS video_id, o_totalprice AS price, o_orderkey % 2 = 0 AS raw FROM orders")
def p29_raw_or_shaped(spark, sf) -> DataFrame:
    """Rows that already have the shape pass; raw ones are projected."""
    o = table(spark, sf, "orders")
    raw = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_totalprice").alias("price")).alias("stats"))
    shaped = o.where("o_orderkey % 2 <> 0").select(F.col("o_orderkey").cast("string").alias("video_id"), F.col("o_totalprice").alias("price"))

    def rows(d: DataFrame) -> DataFrame:
        if "video_id" in d.columns:
            return d.select("video_id", "price", F.lit(False).alias("raw"))
        return d.select(F.col("id").cast("string").alias("video_id"), F.col("stats.price").alias("price"), F.lit(True).alias("raw"))

    return rows(raw).unionByName(rows(shaped))


@query("SELECT event_id, event_type, user_id FROM events UNION ALL SELECT event_id, event_type, user_id FROM events WHERE event_type = 'error'")
def st6_event_log(spark, sf) -> DataFrame:
    path, e = L.workspace(spark, "log"), table(spark, sf, "events").select("event_id", "event_type", "user_id")
    for rows in (e, e.where("event_type = 'error'")):
        writers.append(rows, path)
    return spark.read.schema(e.schema).parquet(path)


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS rows, sum(value) > 0 AS any_value FROM events GROUP BY 1")
def x02_row_callback(spark, sf) -> DataFrame:
    """A function handed in sees each day's rows as they come and what it returns is kept."""
    def on_day(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day").agg(F.count("*").alias("rows"), (F.sum("value") > 0).alias("any_value"))

    return table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")).transform(on_day)


