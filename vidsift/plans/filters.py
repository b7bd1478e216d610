"""Projections, predicates, SQL-level functions and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as C
from ..operators import relational as R
from ..registry import query
from ..session import table

LEAD = ["o_orderstatus", "o_orderdate"]


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p01_projection(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderstatus, o_orderdate, o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def p02_status_columns_first(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(*LEAD, *[c for c in o.columns if c not in LEAD])


@query("SELECT * EXCLUDE (n_chars, text) FROM documents")
def p03_select_except(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").drop("n_chars", "text")


@query("SELECT o_orderkey AS video_id, o_custkey AS username, o_totalprice AS likes, o_orderstatus AS collection_status FROM orders")
def p04_rename_map(spark, sf) -> DataFrame:
    names = {"o_orderkey": "video_id", "o_custkey": "username", "o_totalprice": "likes", "o_orderstatus": "collection_status"}
    return table(spark, sf, "orders").select(*names).withColumnsRenamed(names)


@query("""
SELECT event_id, 'https://example.com/@' || user_id || '/video/' || event_id AS video_url, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS posted_at, coalesce(value, 0) AS like_count,
       coalesce(json_extract_string(props, '$.k'), '') AS tag, 'handle' AS collection_source, 'pipeline_1' AS pipeline_id FROM events""")
def p05_normalising_projection(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    url = F.concat(F.lit("https://example.com/@"), F.col("user_id").cast("string"), F.lit("/video/"), F.col("event_id").cast("string"))
    return e.select("event_id", url.alias("video_url"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("posted_at"), F.coalesce("value", F.lit(0.0)).alias("like_count"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("")).alias("tag"), F.lit("handle").alias("collection_source"), F.lit("pipeline_1").alias("pipeline_id"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey = 7 OR strftime(o_orderdate, '%Y-%m-%d') = '1996-03-01'")
def p07_equality(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where((F.col("o_custkey") == 7) | (F.date_format("o_orderdate", "yyyy-MM-dd") == "1996-03-01")).select("o_orderkey")


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src5', 'src9')")
def p08_in_list(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where(F.col("source").isin("src1", "src5", "src9")).select("doc_id", "source")


@query("SELECT doc_id, lang FROM documents WHERE lang IN (SELECT unnest(['fr', 'de']))")
def p09_in_array_parameter(spark, sf) -> DataFrame:
    return spark.sql("SELECT doc_id, lang FROM {d} WHERE array_contains(:langs, lang)", args={"langs": F.array(F.lit("fr"), F.lit("de"))}, d=table(spark, sf, "documents"))


@query(r"SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '\s+'), 'the')")
def p10_array_membership(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where(F.array_contains(F.split(F.lower("text"), r"\s+"), "the")).select("doc_id")


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def p11_half_open_range(spark, sf) -> DataFrame:
    return table(spark, sf, "events").where("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-11'").select("event_id", "user_id")


@query("""
SELECT event_id FROM events WHERE strftime(ts, '%Y-%m-%d %H:%M:%S') >= '2024-01-05' AND strftime(ts, '%Y-%m-%d %H:%M:%S') <= '2024-01-07' || ' 23:59:59'""")
def p12_text_date_range(spark, sf) -> DataFrame:
    t = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").where((t >= "2024-01-05") & (t <= "2024-01-07 23:59:59")).select("event_id")


@query("SELECT event_id FROM events WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-24' AND ts > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
def p13_last_days(spark, sf, today: str = "2024-01-31") -> DataFrame:
    e = table(spark, sf, "events")
    day = F.date_format(F.date_sub(F.lit(today).cast("date"), 7), "yyyy-MM-dd")
    return e.where((F.date_format("ts", "yyyy-MM-dd") >= day) & (F.col("ts") > F.expr(f"timestamp_ntz'{today}' - INTERVAL 7 DAYS"))).select("event_id")


@query("""
SELECT doc_id, (text IS NULL OR text = '') AS missing, length(coalesce(text, '')) > 0 AS filled, trim(coalesce(source, '')) <> '' AS named FROM documents
WHERE NOT (text IS NULL OR text = '')""")
def p15_presence(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", R.missing("text").alias("missing"), (F.length(F.coalesce("text", F.lit(""))) > 0).alias("filled"), (F.trim(F.coalesce("source", F.lit(""))) != "").alias("named"))
    return d.where(~F.col("missing"))


@query("SELECT doc_id, source FROM documents WHERE source LIKE 'src1%' AND NOT starts_with(lang, 'e')")
def p16_like_and_prefix(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where(F.col("source").like("src1%") & ~F.col("lang").startswith("e")).select("doc_id", "source")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'A' WHEN o_totalprice >= 100000 THEN 'B' WHEN o_totalprice >= 50000 THEN 'C' ELSE 'D' END AS bucket
FROM orders WHERE o_orderstatus = 'O' OR o_totalprice < 60000""")
def p19_case_buckets(spark, sf) -> DataFrame:
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").where((F.col("o_orderstatus") == "O") | (p < 60000)).select("o_orderkey", F.when(p >= 200000, "A").when(p >= 100000, "B").when(p >= 50000, "C").otherwise("D").alias("bucket"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_name <> '' AND NOT regexp_matches(c_name, '[ ()]')")
def p20_dirty_handles(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").where(X.collectable(F.col("c_name"))).select("c_custkey", "c_name")


@query("""
SELECT doc_id, n_chars < 200 AND strpos(text, '|') = 0 AS needs_work FROM documents""")
def p22_needs_work(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", ((F.col("n_chars") < 200) & (F.instr("text", "|") == 0)).alias("needs_work"))


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN coalesce(text, '') = '' THEN 'missing_text' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'wrong_pipeline' END,
       CASE WHEN NOT regexp_full_match(doc_id::VARCHAR, '[0-9]{2,}') THEN 'bad_id' END, CASE WHEN len(regexp_extract_all(lower(text), 'the')) = 0 THEN 'missing_matched_keywords' END) AS errors FROM documents""")
def p23_validation_errors(spark, sf) -> DataFrame:
    from ..functions.score import reasons

    none = F.size(F.regexp_extract_all(F.lower("text"), F.lit("the"), F.lit(0))) == 0
    e = reasons((R.missing("text"), "missing_text"), (~F.col("lang").isin("en", "fr"), "wrong_pipeline"), (~F.col("doc_id").cast("string").rlike("^[0-9]{2,}$"), "bad_id"), (none, "missing_matched_keywords"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(e, ",").alias("errors"))


@query("""
SELECT column_name AS field, CASE WHEN column_name IN ('doc_id', 'text', 'lang') THEN 'declared' ELSE 'extra' END AS state FROM (DESCRIBE documents)
UNION ALL SELECT 'posted_at', 'missing'""")
def p24_schema_drift(spark, sf) -> DataFrame:
    have, want = table(spark, sf, "documents").columns, ["doc_id", "text", "lang", "posted_at"]
    return spark.createDataFrame([(c, "declared" if c in want else "extra") for c in have] + [(c, "missing") for c in want if c not in have], "field string, state string")


@query("""
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL AND d.doc_id >= 100 AND d.source IN ('src0', 'src1', 'src2')""")
def p25_not_labelled(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").where((F.col("doc_id") >= 100) & F.col("source").isin("src0", "src1", "src2"))
    return R.pending(d, table(spark, sf, "labels").where("quality is not null"), "doc_id").select("doc_id", "lang")


@query("""
SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), 'pipeline_1') AS pipeline_id,
       CASE source WHEN 'src1' THEN 'p1' WHEN 'src2' THEN 'p2' WHEN 'src3' THEN 'p3' END AS canonical FROM documents""")
def p26_defaults_and_aliases(spark, sf) -> DataFrame:
    alias = F.create_map(*[F.lit(x) for kv in (("src1", "p1"), ("src2", "p2"), ("src3", "p3")) for x in kv])
    return table(spark, sf, "documents").select("doc_id", R.first_filled(F.when(F.col("lang") == "en", "").otherwise(F.col("lang")), F.lit("pipeline_1")).alias("pipeline_id"), F.try_element_at(alias, F.col("source")).alias("canonical"))


@query("""
SELECT doc_id, coalesce(nullif(source, 'src1'), 'none') AS a, length(text)::INTEGER AS n, upper(substr(lang, 1, 1)) AS c, round(n_chars / 7.0, 3) AS r,
       greatest(0, least(100, n_chars - 500)) AS clamped, doc_id % 7 AS m, doc_id // 7 AS d, starts_with(source, 'src1') AS s, lpad(doc_id::VARCHAR, 6, '0') AS padded FROM documents""")
def f01_scalar_functions(spark, sf) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.nullif("source", F.lit("src1")), F.lit("none")).alias("a"), F.length("text").alias("n"), F.upper(F.substr("lang", F.lit(1), F.lit(1))).alias("c"), F.round(n / 7.0, 3).alias("r"), F.greatest(F.lit(0), F.least(F.lit(100), n - 500)).alias("clamped"), (F.col("doc_id") % 7).alias("m"), F.expr("doc_id div 7").alias("d"), F.col("source").startswith("src1").alias("s"), F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("padded"))


@query("""
SELECT event_id, strftime(ts, '%Y%m%d') AS compact, strftime(ts - INTERVAL 3 DAY, '%Y-%m-%d') AS three_before, strftime(ts, '%Y-%m-%d') AS day, floor(epoch(ts))::BIGINT AS unix,
       dayofweek(ts)::INTEGER + 1 AS dow FROM events""")
def f05_date_functions(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("compact"), F.date_format(F.expr("ts - INTERVAL 3 DAYS"), "yyyy-MM-dd").alias("three_before"), F.to_date("ts").cast("string").alias("day"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix"), F.dayofweek("ts").alias("dow"))


@query("""
SELECT stamp_id, CASE WHEN regexp_full_match(raw, '[0-9]{8}') THEN try_strptime(raw, '%Y%m%d')::DATE::VARCHAR END AS day,
       CASE WHEN regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:]{8}') THEN try_strptime(raw, '%Y-%m-%d %H:%M:%S') END AS instant FROM stamps""")
def f07_safe_parse(spark, sf) -> DataFrame:
    """Texts of many forms as a day or an instant where they have its form and are one, else null."""
    s = table(spark, sf, "stamps")
    day = F.when(F.col("raw").rlike(r"^\d{8}$"), F.try_to_date("raw", "yyyyMMdd"))
    instant = F.when(F.col("raw").rlike(r"^\d{4}-\d{2}-\d{2} [\d:]{8}$"), F.try_to_timestamp("raw", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))
    return s.select("stamp_id", day.cast("string").alias("day"), instant.alias("instant"))


@query("""
SELECT c_custkey, '{"c_name":' || to_json(c_name) || ',"c_mktsegment":' || to_json(c_mktsegment) || ',"missing":null}' AS fingerprint FROM customer""")
def f12_json_fingerprint(spark, sf) -> DataFrame:
    s = F.struct("c_name", "c_mktsegment", F.lit(None).cast("string").alias("missing"))
    return table(spark, sf, "customer").select("c_custkey", F.to_json(s, {"ignoreNullFields": "false"}).alias("fingerprint"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def f13_array_to_string(spark, sf) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), " | ").alias("kinds"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, try_cast(json_extract_string(props, '$.none') AS BIGINT) AS none FROM events")
def f25_json_decode(spark, sf) -> DataFrame:
    j = F.from_json("props", "struct<k:long,none:long>")
    return table(spark, sf, "events").select("event_id", j["k"].alias("k"), j["none"].alias("none"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 300000")
def f17_parameters(spark, sf) -> DataFrame:
    return spark.sql("SELECT o_orderkey, o_totalprice FROM {o} WHERE o_orderstatus = :status AND o_totalprice >= :least", args={"status": "F", "least": 300000.0}, o=table(spark, sf, "orders"))


@query("""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-13-%d') END AS raw FROM orders)
SELECT o_orderkey, coalesce(try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%Y%m%d'))::DATE::VARCHAR AS day FROM r""")
def c01_research_date(spark, sf) -> DataFrame:
    """Research days written in two accepted forms, one that is not, and with a month that does not exist."""
    forms = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "yyyy-'13'-dd")
    raw = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", f)) for i, f in enumerate(forms)])
    return table(spark, sf, "orders").select("o_orderkey", C.research_date(raw).cast("string").alias("day"))


@query("""
SELECT day::VARCHAR AS day, strftime(timezone('UTC', timezone('America/Chicago', day::TIMESTAMP)), '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(timezone('UTC', timezone('America/Chicago', (day + 1)::TIMESTAMP)), '%Y-%m-%dT%H:%M:%SZ') AS window_end,
       strftime(timezone('UTC', timezone('America/Chicago', day::TIMESTAMP)), '%Y%m%d') AS first_day,
       strftime(timezone('UTC', timezone('America/Chicago', (day + 1)::TIMESTAMP)) - INTERVAL 1 MICROSECOND, '%Y%m%d') AS last_day
FROM (SELECT DISTINCT o_orderdate::DATE AS day FROM orders)""")
def c02_civil_day_window(spark, sf) -> DataFrame:
    """The civil day in Chicago of every order date, those of 23 and 25 hours among them."""
    v = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    a, b = C.civil_window(F.col("day"), "America/Chicago")
    first, last = C.api_dates(a, b)
    return v.select(F.col("day").cast("string").alias("day"), C.instant(a).alias("window_start"), C.instant(b).alias("window_end"), first.alias("first_day"), last.alias("last_day"))


@query("""
SELECT o_orderkey, n::INTEGER AS n, (s + INTERVAL (30 * n) DAY)::DATE::VARCHAR AS chunk_start, least((s + INTERVAL (30 * (n + 1)) DAY)::DATE, e)::VARCHAR AS chunk_end
FROM (SELECT o_orderkey, o_orderdate::DATE AS s, (o_orderdate::DATE + (o_custkey % 100)::INTEGER) AS e FROM orders), range(0, 4) r(n)
WHERE s + INTERVAL (30 * n) DAY < e""")
def c06_chunks(spark, sf) -> DataFrame:
    """The span from each order's date on, of 0 to 99 days, in chunks of 30 days that share their ends."""
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, (F.col("o_custkey") % 100).cast("int"))
    each = table(spark, sf, "orders").select("o_orderkey", F.posexplode(C.chunks(start, end)).alias("n", "c"))
    return each.select("o_orderkey", "n", F.col("c.start").cast("string").alias("chunk_start"), F.col("c.end").cast("string").alias("chunk_end"))


@query("""
SELECT event_id, strftime(make_timestamp(floor(epoch(ts))::BIGINT * 1000000), '%Y-%m-%d %H:%M:%S UTC') AS posted_at, (strftime(ts, '%H')::INTEGER < 12) AS morning FROM events""")
def c08_epoch_text(spark, sf) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", C.epoch_text(seconds).alias("posted_at"), (F.hour("ts") < 12).alias("morning"))


@query("""
SELECT event_id, strftime(timezone('America/Chicago', timezone('UTC', ts))::DATE - 2, '%Y-%m-%d') AS research_day FROM events""")
def c05_lagged_day(spark, sf) -> DataFrame:
    """The day two days before each event's, by Chicago's clock."""
    return table(spark, sf, "events").select("event_id", F.date_format(C.lagged(F.col("ts").cast("timestamp"), 2, "America/Chicago"), "yyyy-MM-dd").alias("research_day"))
