"""Queries over stored tables: added columns, point lookups, checked exports and archives; and functions for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sql as S
from ..operators import relational as R
from ..registry import query
from ..session import table
from ..sources import landed as L
from ..sources import stores, writers


@query("""
SELECT o_orderkey, o_custkey, NULL::VARCHAR AS note, NULL::VARCHAR[] AS tags FROM orders WHERE year(o_orderdate) < 1998
UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, [o_orderstatus, o_orderpriority] FROM orders WHERE NOT year(o_orderdate) < 1998""")
def k19_stored_columns_added(spark, sf) -> DataFrame:
    """A catalogue table gets a text and a list column after its first rows were stored; old and new files are read together."""
    o = table(spark, sf, "orders")
    early = F.year("o_orderdate") < 1998
    name = stores.stored_table(spark, "vidsift_orders", "o_orderkey BIGINT, o_custkey BIGINT", L.workspace(spark, "orders"))
    o.where(early).select("o_orderkey", "o_custkey").write.insertInto(name)
    stores.add_missing_columns(spark, name, "O_ORDERKEY BIGINT, note STRING, tags ARRAY<STRING>")
    o.where(~early).select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("note"), F.array("o_orderstatus", "o_orderpriority").alias("tags")).write.insertInto(name)
    return spark.table(name)


@query("""
WITH w AS (SELECT DISTINCT client_id FROM clients WHERE client_id IS NOT NULL)
SELECT c.client_id, arg_max(click_id, {'ts': ts, 'id': click_id}) AS click_id, floor(date_diff('day', DATE '1970-01-01', max(ts)::DATE) / 30)::INTEGER AS chunk
FROM clicks c JOIN w USING (client_id) WHERE kind = 'purchase' AND ts IS NOT NULL AND click_id IS NOT NULL GROUP BY 1""")
def s11_point_lookup(spark, sf) -> DataFrame:
    """The newest purchase of each known client, from a layout by chunk and slot that is read newest chunk first."""
    path = L.workspace(spark, "clicks")
    bought = table(spark, sf, "clicks").where("kind = 'purchase' and ts is not null and click_id is not null")
    stores.lay_out(bought.select("client_id", "click_id", "ts"), "client_id", "ts", path)
    store = spark.read.schema("client_id long, click_id long, ts timestamp_ntz, chunk int, slot int").parquet(path)
    wanted = table(spark, sf, "clients").where("client_id is not null").select("client_id")
    return stores.newest_first(store, "client_id", wanted, ["ts", "click_id"]).select("client_id", "click_id", "chunk")


@query("""
SELECT event_type AS kind, count(*) AS rows, count(*) AS read_back, 0::BIGINT AS other_days, count_if(value < 10)::BIGINT AS failed FROM events GROUP BY 1""")
def k24_observed_export(spark, sf) -> DataFrame:
    """One CSV export a kind of event: counts taken while it is written, compared with the rows read back."""
    e = table(spark, sf, "events")
    kinds = sorted(r.event_type for r in e.select("event_type").distinct().collect())  # the five kinds
    done = []
    for kind in kinds:
        rows = e.where(F.col("event_type") == kind).select("event_id", F.lit("2024-02-01").alias("collection_date"), F.when(F.col("value") < 10, "api_failed").otherwise("ok").alias("collection_status"), "props")
        done.append((kind, stores.export(rows, L.workspace(spark, "export"), "2024-02-01", ("collection_status",))))
    return spark.createDataFrame([(k, c["rows"], c["read_back"], c["other_days"], c["failed"]) for k, c in done], "kind string, rows long, read_back long, other_days long, failed long")


@query("""
SELECT 'status,id,day,note' AS line, true AS header UNION ALL
SELECT o_orderstatus || ',' || o_orderkey || ',' || strftime(o_orderdate, '%Y-%m-%d') || ',' || CASE WHEN o_custkey % 2 = 0 THEN '"a ""b"", c"' ELSE '' END, false FROM orders""")
def k20_csv_with_mark(spark, sf) -> DataFrame:
    """The lines of an export that a byte order mark opens (text readers skip it): header, status first, quotes doubled."""
    note = F.when(F.col("o_custkey") % 2 == 0, 'a "b", c')
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), note.alias("note"), F.col("o_orderstatus").alias("status"))
    path = L.workspace(spark, "marked")
    writers.write_csv(o, path, ("status",), mark=True)
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("value").contains("status,id").alias("header"))
    return lines.where("not header").unionByName(lines.where("header").distinct())  # each file has one


@query("""
SELECT 'read' AS action, event_type AS target, count(*) AS n, 1::INTEGER AS run FROM events GROUP BY 2
UNION ALL SELECT 'retry', event_type, count(*), 2 FROM events WHERE value < 10 GROUP BY 2""")
def k30_audit_log(spark, sf) -> DataFrame:
    """Rows of two runs appended to a stored audit log; the second adds to what the first left."""
    path, e = L.workspace(spark, "audit"), table(spark, sf, "events")
    for run, (action, rows) in enumerate((("read", e), ("retry", e.where("value < 10"))), 1):
        told = rows.groupBy(F.col("event_type").alias("target")).agg(F.count("*").alias("n"))
        writers.append(told.select(F.lit(action).alias("action"), "target", "n", F.lit(run).alias("run")), path)
    return spark.read.schema("action string, target string, n long, run int").parquet(path)


@query("""SELECT 'p1_events/2024-02-01' AS object, true AS replaced, true AS has_bytes, event_id, event_type FROM events WHERE event_type <> 'error'""")
def k25_archived_object(spark, sf) -> DataFrame:
    """An export archived under its day, a second one in its place, and the rows of what lies there."""
    e, root = table(spark, sf, "events").select("event_id", "event_type"), L.workspace(spark, "archive")
    told = None
    for rows in (e, e.where("event_type <> 'error'")):
        path = L.workspace(spark, "export")
        stores.export(rows.withColumns({"collection_date": F.lit("2024-02-01"), "collection_status": F.lit("ok")}), path, "2024-02-01")
        told = stores.archive(spark, path, root, "p1_events", "2024-02-01")
    back = spark.read.option("header", True).csv(told["uri"])
    name = told["uri"].removeprefix(f"{root}/")
    return back.select(F.lit(name).alias("object"), F.lit(told["replaced"]).alias("replaced"), F.lit(told["bytes"] > 0).alias("has_bytes"), F.col("event_id").cast("long").alias("event_id"), "event_type")


@query("""
WITH f AS (
  SELECT *, {'a': valid_at, 'b': seq, 'c': op, 'd': coalesce(source, ''), 'e': coalesce(segment, ''), 'f': coalesce(city, '')} AS print FROM client_changes WHERE client_id IS NOT NULL),
b AS (
  SELECT client_id, print AS best FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY valid_at DESC NULLS LAST, seq DESC NULLS LAST, op DESC NULLS LAST, coalesce(source, '') DESC, coalesce(segment, '') DESC, coalesce(city, '') DESC) AS rn FROM f) WHERE rn = 1)
SELECT change_id, f.client_id, seq, op FROM f JOIN b ON f.client_id = b.client_id AND f.print IS NOT DISTINCT FROM b.best""")
def w06_keep_best_rows(spark, sf) -> DataFrame:
    """Of each client's changes all rows that equal the newest one in six fields stay, the others go."""
    six = {"a": F.col("valid_at"), "b": F.col("seq"), "c": F.col("op"), "d": F.coalesce("source", F.lit("")), "e": F.coalesce("segment", F.lit("")), "f": F.coalesce("city", F.lit(""))}
    changes = table(spark, sf, "client_changes").where("client_id is not null")
    return R.keep_best(changes, "client_id", six).select("change_id", "client_id", "seq", "op")


@query("""
WITH n AS (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(event_type, '|' ORDER BY rn) FILTER (WHERE rn <= 2) AS leading FROM n GROUP BY 1""")
def x01_sql_aggregate(spark, sf) -> DataFrame:
    """An aggregate of the engine called in SQL; what it is given is added up first, one row a user and kind."""
    S.register(spark)
    return spark.sql("SELECT user_id, vidsift_leading(event_type, n) AS leading FROM (SELECT user_id, event_type, count(*) AS n FROM {e} GROUP BY 1, 2) GROUP BY user_id", e=table(spark, sf, "events"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
w AS (SELECT doc_id, line, list_filter(string_split(t, ' '), lambda x: x <> '') AS w FROM l)
SELECT doc_id, line::INTEGER AS line, len(w)::INTEGER AS words, w[1] AS first FROM w WHERE len(w) > 0""")
def x01_sql_table_function(spark, sf) -> DataFrame:
    """A table function of the engine called in SQL for every whole text."""
    S.register(spark)
    return spark.sql("SELECT d.doc_id, x.line, x.words, x.first FROM {d} d, LATERAL vidsift_lines(d.text) x", d=table(spark, sf, "documents"))
