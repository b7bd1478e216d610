"""Ranking, first-seen order, failure streaks, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..registry import query
from ..session import table


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def w01_latest_per_key(spark, sf) -> DataFrame:
    return R.row_one(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
ORDER BY coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END, TIMESTAMP '1970-01-01') DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def w02_latest_with_default(spark, sf) -> DataFrame:
    at = F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")), F.expr("timestamp_ntz'1970-01-01'"))
    return R.row_one(table(spark, sf, "orders"), ["o_custkey"], [at.desc(), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("""
SELECT o_custkey, o_orderkey, rn::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 5""")
def w03_top_n_per_group(spark, sf) -> DataFrame:
    return R.top_per_group(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5, "rank").select("o_custkey", "o_orderkey", "rank")


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 3 AND o_orderstatus <> 'F'""")
def w04_rank_then_filter(spark, sf) -> DataFrame:
    top = R.top_per_group(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3)
    return top.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey")


@query("""
WITH f AS (SELECT text, lang, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS rn, doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents)
SELECT doc_id, lang, n AS copies FROM f WHERE rn = 1 AND n > 1""")
def w06_keep_best_copy(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").withColumn("copies", F.count("*").over(Window.partitionBy("text"))).where("copies > 1")
    return R.row_one(d, ["text"], [F.desc("n_chars"), F.asc("doc_id")]).select("doc_id", "lang", "copies")


@query("""
SELECT word, first_at, row_number() OVER (ORDER BY first_at, word)::INTEGER AS place
FROM (SELECT lower(source) AS word, min(doc_id) AS first_at FROM documents GROUP BY 1)""")
def w07_first_seen_order(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").groupBy(F.lower("source").alias("word")).agg(F.min("doc_id").alias("first_at"))
    return R.numbered(d, ["first_at", "word"], "place")


@query("""
WITH a AS (SELECT user_id, event_id, ts, (event_type = 'error')::INTEGER AS failed FROM events),
b AS (SELECT *, count(*) OVER w AS attempts, sum(failed) OVER w AS failures, sum(1 - failed) OVER w AS island FROM a WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT user_id, event_id, failed, attempts, failures::BIGINT AS failures, sum(failed) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS in_a_row,
       (sum(failed) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) >= 8 OR (attempts >= 20 AND failures * 4 >= attempts)) AS stop FROM b""")
def w08_failure_streaks(spark, sf) -> DataFrame:
    s = R.streaks(table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    stop = (F.col("in_a_row") >= 8) | ((F.col("attempts") >= 20) & (F.col("failures") * 4 >= F.col("attempts")))
    return s.select("user_id", "event_id", "failed", "attempts", "failures", "in_a_row", stop.alias("stop"))


@query("""
SELECT user_id, event_type, string_agg(event_id::VARCHAR, ',' ORDER BY event_id DESC) AS last_ids
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 3 GROUP BY 1, 2""")
def w09_last_k(spark, sf) -> DataFrame:
    top = R.top_per_group(table(spark, sf, "events"), ["user_id", "event_type"], [F.desc("event_id")], 3)
    return top.groupBy("user_id", "event_type").agg(F.array_join(F.sort_array(F.collect_list("event_id"), asc=False).cast("array<string>"), ",").alias("last_ids"))


@query("""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END AS status_rank, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders ORDER BY status_rank, day DESC, o_orderkey DESC""")
def o01_status_first_sort(spark, sf) -> DataFrame:
    d = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("status_rank"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return d.orderBy("status_rank", F.desc("day"), F.desc("o_orderkey"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority LIKE '1%' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o02_top_samples(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderpriority").like("1%")).select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


def limited(df: DataFrame, n: int | None) -> DataFrame:
    """LIMIT only when asked for."""
    return df if n is None else df.limit(n)


@query("SELECT doc_id, source FROM documents WHERE strpos(text, '#') > 0 ORDER BY doc_id LIMIT 10")
def o03_optional_limit(spark, sf) -> DataFrame:
    return limited(table(spark, sf, "documents").where("instr(text, '#') > 0").select("doc_id", "source").orderBy("doc_id"), 10)


@query("""
SELECT user_id, priority FROM (SELECT user_id, CASE WHEN count_if(event_type = 'error') >= 20 THEN 'A' WHEN count_if(event_type = 'error') >= 12 THEN 'B' ELSE 'C' END AS priority FROM events GROUP BY 1)
ORDER BY priority, user_id""")
def o04_priority_sort(spark, sf) -> DataFrame:
    n = F.count_if(F.col("event_type") == "error")
    return table(spark, sf, "events").groupBy("user_id").agg(F.when(n >= 20, "A").when(n >= 12, "B").otherwise("C").alias("priority")).orderBy("priority", "user_id")


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01') WHERE rn <= 2""")
def o09_recent_per_creator(spark, sf) -> DataFrame:
    d = table(spark, sf, "orders").where("o_orderdate >= timestamp_ntz'1996-01-01'")
    return R.top_per_group(d, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 2).select("o_custkey", "o_orderkey")


@query("SELECT c_custkey AS k, 'c' AS side FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier")
def u01_union_all(spark, sf) -> DataFrame:
    side = lambda t, c, s: table(spark, sf, t).select(F.col(c).alias("k"), F.lit(s).alias("side"))
    return side("customer", "c_custkey", "c").unionByName(side("supplier", "s_suppkey", "s"))


@query("SELECT source AS k FROM documents UNION SELECT lang FROM documents")
def u02_union_distinct(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("k")).union(d.select(F.col("lang").alias("k"))).distinct()


def halves(df: DataFrame) -> DataFrame:
    """(doc_id, a, b): the words of the first and of the second half of each whole text."""
    w = df.select("doc_id", F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+"), lambda x: x != "").alias("w")).withColumn("h", F.ceil(F.size("w") / 2).cast("int"))
    return w.select("doc_id", F.slice("w", F.lit(1), F.col("h")).alias("a"), F.slice("w", F.col("h") + 1, F.size("w")).alias("b"))


HALVES_SQL = r"""k AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS k FROM documents),
w AS (SELECT doc_id, list_slice(k, 1, (len(k) + 1) // 2) AS a, list_slice(k, (len(k) + 1) // 2 + 1, len(k)) AS b FROM k)"""


@query(f"""
WITH {HALVES_SQL},
u AS (SELECT doc_id, word, min(i) AS i FROM (SELECT doc_id, unnest(list_concat(b, a)) AS word, generate_subscripts(list_concat(b, a), 1) AS i FROM w) GROUP BY 1, 2),
m AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS merged FROM u GROUP BY 1)
SELECT doc_id, coalesce(merged, '') AS merged FROM w LEFT JOIN m USING (doc_id)""")
def u03_ordered_union(spark, sf) -> DataFrame:
    return halves(table(spark, sf, "documents")).select("doc_id", F.array_join(F.array_union("b", "a"), " ").alias("merged"))


@query(f"""
WITH {HALVES_SQL}, s AS (SELECT doc_id, len(list_intersect(a, b))::BIGINT AS common, len(list_distinct(list_concat(a, b)))::BIGINT AS either FROM w)
SELECT *, CASE WHEN either = 0 THEN 1.0 ELSE round(common::DOUBLE / either, 4) END AS jaccard FROM s""")
def u04_jaccard(spark, sf) -> DataFrame:
    d = halves(table(spark, sf, "documents"))
    c, e = F.size(F.array_intersect("a", "b")), F.size(F.array_union("a", "b"))
    return d.select("doc_id", c.cast("long").alias("common"), e.cast("long").alias("either"), F.when(e == 0, 1.0).otherwise(F.round(F.try_divide(c.cast("double"), e), 4)).alias("jaccard"))


@query("""SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def u05_difference(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id").exceptAll(table(spark, sf, "labels").select("doc_id")).distinct()
