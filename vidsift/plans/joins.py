"""Lookups, pending work, overlaps and candidate expansion as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import overlaps as V
from ..operators import relational as R
from ..registry import query
from ..session import cut, table


@query("SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def j01_left_dim(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, F.col("c_custkey") == F.col("o_custkey"), "left").select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("""
SELECT o_orderkey, count(l_orderkey) AS lines, coalesce(sum(l_quantity), 0)::BIGINT AS quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY 1""")
def j02_left_on_filter(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("q"))
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("q", F.lit(0)).cast("long").alias("quantity"))


@query("""
SELECT l_orderkey, l_linenumber, o_orderstatus, c_name, n_name, r_name FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
WHERE l_quantity >= 40""")
def j03_star(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").where("l_quantity >= 40").select("l_orderkey", "l_linenumber")
    d = li.join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"), "left").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    d = d.join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return d.select("l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name")


@query("""
SELECT d.doc_id, (SELECT string_agg(c.text, ' ' ORDER BY c.turn, c.text) FROM conversations c WHERE c.conv_id = d.doc_id) AS replies FROM documents d""")
def j04_correlated_concat(spark, sf) -> DataFrame:
    per = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.sort_array(F.collect_list(F.struct("turn", "text")))["text"], " ").alias("replies"))
    return table(spark, sf, "documents").select("doc_id").join(per, "doc_id", "left")


@query("""
SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)""")
def j05_anti_needs_work(spark, sf) -> DataFrame:
    return R.pending(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels").where("quality = 1 and toxic = 0"), "doc_id")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def j06_anti_distinct(spark, sf) -> DataFrame:
    done = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.pending(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), done, "o_orderkey")


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0.1)
OR o_orderkey IN (SELECT event_id FROM events WHERE event_type = 'error') OR o_orderkey IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def j07_semi_any_of(spark, sf) -> DataFrame:
    k = lambda t, c, w: table(spark, sf, t).where(w).select(F.col(c).alias("o_orderkey"))
    return R.any_of(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", k("lineitem", "l_orderkey", "l_discount = 0.1"), k("events", "event_id", "event_type = 'error'"), k("labels", "doc_id", "toxic = 1"))


@query("""
SELECT o_orderkey, coalesce(c_mktsegment, 'unknown') AS account_type, coalesce(c_acctbal, 0) AS followers FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def j08_creator_lookup(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return table(spark, sf, "orders").join(c, "o_custkey", "left").select("o_orderkey", F.coalesce("c_mktsegment", F.lit("unknown")).alias("account_type"), F.coalesce("c_acctbal", F.lit(0.0)).alias("followers"))


@query("""
SELECT o_orderkey, coalesce(f.frames, '') AS frames, coalesce(f.n, 0) AS n_frames, coalesce(e.n, 0) AS n_events FROM orders
LEFT JOIN (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ' ' ORDER BY l_linenumber, l_returnflag) AS frames, count(*) AS n FROM lineitem GROUP BY 1) f ON f.l_orderkey = o_orderkey
LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON e.user_id = o_custkey""")
def j09_children_arrays(spark, sf) -> DataFrame:
    frames = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    o = R.with_children(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), frames, "o_orderkey", ["l_linenumber", "l_returnflag"], ["l_linenumber", "l_returnflag"], "kids")
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("o_custkey")).agg(F.count("*").alias("n"))
    text = F.array_join(F.transform("kids", lambda k: F.concat(k["l_linenumber"].cast("string"), F.lit(":"), k["l_returnflag"])), " ")
    return o.join(e, "o_custkey", "left").select("o_orderkey", text.alias("frames"), F.size("kids").cast("long").alias("n_frames"), F.coalesce("n", F.lit(0)).alias("n_events"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
SELECT c_custkey, max(CASE WHEN event_type = 'error' THEN props END) AS last_error, max(CASE WHEN event_type = 'view' THEN value END) AS last_latency
FROM customer LEFT JOIN r ON user_id = c_custkey AND rn = 1 GROUP BY 1""")
def j10_latest_event(spark, sf) -> DataFrame:
    pick = lambda t, c: F.max_by(F.when(F.col("event_type") == t, F.col(c)), F.when(F.col("event_type") == t, F.col("event_id")))
    last = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(pick("error", "props").alias("last_error"), pick("view", "value").alias("last_latency"))
    return table(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left")


@query("""
SELECT o_orderkey, coalesce(nullif(c.n, 0), f.n, 0) AS frames, coalesce(nullif(f.q, 0), o_totalprice) AS duration FROM orders
LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) c ON c.conv_id = o_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) f ON f.l_orderkey = o_orderkey""")
def j11_fallback_chain(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("o_orderkey")).agg(F.count("*").alias("cn"))
    f = table(spark, sf, "lineitem").where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("fn"), F.sum("l_quantity").alias("q"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(c, "o_orderkey", "left").join(f, "o_orderkey", "left")
    return o.select("o_orderkey", F.coalesce(F.nullif("cn", F.lit(0)), "fn", F.lit(0)).alias("frames"), F.coalesce(F.nullif("q", F.lit(0.0)), "o_totalprice").alias("duration"))


@query("""
SELECT c_custkey, CASE WHEN s1.k IS NOT NULL AND s2.k IS NOT NULL THEN 'overlap' WHEN s1.k IS NOT NULL THEN 'pipeline_1' WHEN s2.k IS NOT NULL THEN 'pipeline_2' END AS owner
FROM customer LEFT JOIN (SELECT DISTINCT s_suppkey AS k FROM supplier WHERE s_suppkey % 2 = 0) s1 ON s1.k = c_custkey
LEFT JOIN (SELECT DISTINCT s_suppkey AS k FROM supplier WHERE s_suppkey % 3 = 0) s2 ON s2.k = c_custkey""")
def j13_exclusion_classify(spark, sf) -> DataFrame:
    s = lambda n, c: table(spark, sf, "supplier").where(F.col("s_suppkey") % n == 0).select(F.col("s_suppkey").alias("c_custkey")).distinct().withColumn(c, F.lit(True))
    d = table(spark, sf, "customer").select("c_custkey").join(s(2, "a"), "c_custkey", "left").join(s(3, "b"), "c_custkey", "left")
    return d.select("c_custkey", F.when(F.col("a") & F.col("b"), "overlap").when(F.col("a"), "pipeline_1").when(F.col("b"), "pipeline_2").alias("owner"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def j12_untracked_handles(spark, sf) -> DataFrame:
    return R.pending(table(spark, sf, "customer").select("c_custkey", "c_name"), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey")), "c_custkey")


@query("""
SELECT doc_id, lang FROM documents WHERE source IN ('src1', 'src2', 'src3') AND doc_id NOT IN (SELECT doc_id FROM labels) AND coalesce(text, '') <> ''""")
def j14_skip_existing(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").where(F.col("source").isin("src1", "src2", "src3") & ~R.missing("text")).select("doc_id", "lang")
    return R.pending(d, table(spark, sf, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE lang = 'fr' INTERSECT SELECT doc_id FROM labels")
def j15_scoped_ids(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where("lang = 'fr'").select("doc_id").intersect(table(spark, sf, "labels").select("doc_id"))


@query("""
SELECT (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT doc_id FROM labels)) AS in_labels,
       (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT conv_id FROM conversations)) AS in_conversations""")
def j16_leak_check(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey")
    n = lambda t, k, c: o.join(table(spark, sf, t).select(F.col(k).alias("o_orderkey")), "o_orderkey", "left_semi").agg(F.count("*").alias(c))
    return n("labels", "doc_id", "in_labels").crossJoin(n("conversations", "conv_id", "in_conversations"))


@query("""
SELECT s_suppkey, g.variant AS candidate, g.rank::INTEGER AS rank FROM supplier,
LATERAL (SELECT * FROM (VALUES (0, replace(lower(s_name), '#', '')), (1, replace(lower(s_name), '#', '_')), (2, replace(lower(s_name), '#', '') || 'news'), (3, replace(lower(s_name), '#', '') || 'tv')) v(rank, variant)) g""")
def j17_entity_candidates(spark, sf) -> DataFrame:
    flat = F.replace(F.lower("s_name"), F.lit("#"), F.lit(""))
    made = F.array(flat, F.replace(F.lower("s_name"), F.lit("#"), F.lit("_")), F.concat(flat, F.lit("news")), F.concat(flat, F.lit("tv")))
    return table(spark, sf, "supplier").select("s_suppkey", F.posexplode(made).alias("rank", "candidate"))


@query("""
WITH w AS (SELECT doc_id, source, list_sort(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]{2,}'))) AS t FROM documents),
c AS (SELECT source, t, min(doc_id) AS class_id, count(*) AS n FROM w GROUP BY 1, 2),
l AS (SELECT a.class_id, sum(b.n) AS links FROM c a JOIN c b ON a.source IS NOT DISTINCT FROM b.source AND a.class_id <> b.class_id AND 5 * len(b.t) >= 4 * len(a.t) AND 5 * len(a.t) >= 4 * len(b.t)
  WHERE len(a.t) > 0 AND 5 * len(list_intersect(a.t, b.t)) >= 4 * len(list_distinct(list_concat(a.t, b.t))) GROUP BY 1)
SELECT w.doc_id, c.class_id, (c.n - 1 + coalesce(l.links, 0))::BIGINT AS links
FROM w JOIN c ON w.source IS NOT DISTINCT FROM c.source AND w.t = c.t LEFT JOIN l ON l.class_id = c.class_id""")
def j19_similar_pairs(spark, sf) -> DataFrame:
    """One row per document: its class (documents of its source with the same words; the least id) and how many other
    documents of the source have four fifths of the words in common with it, copies counted, none listed.

    Classes meet on a rare shared word (prefix filter), by hashes of their words; parity sketches rule out pairs exactly
    (see operators/overlaps.py), and the whole sets decide what is left. Only prefixes, sketches and the words of pairs
    that are left are shuffled, never every word.
    """
    words = F.sort_array(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z0-9]{2,}"), F.lit(0))))
    said = table(spark, sf, "documents").select("doc_id", "source", words.alias("t"))
    d = cut(said.select("doc_id", F.unhex(F.sha2(F.to_json(F.struct("source", "t")), 256)).alias("h"), F.size("t").alias("size")))
    classes = cut(d.groupBy("h").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"), F.first("size").alias("size")))
    full = classes.where("size > 0").select("class_id", "n")
    hashed = said.select(F.col("doc_id").alias("class_id"), F.xxhash64("source").alias("of"), F.transform("t", lambda w: F.xxhash64(w)).alias("t"))
    prefixes = cut(V.prefixes(hashed, "class_id", "of", "t", 4, 5).join(full.select("class_id"), "class_id", "left_semi"))
    pairs = cut(V.candidates(prefixes, "class_id", 4, 5))
    side = lambda i: said.join(full, F.col("doc_id") == F.col("class_id")).select(F.col("class_id").alias(i), F.struct("source", "t", "n").alias(f"k{i}"))
    alike = F.col("ka.source").eqNullSafe(F.col("kb.source")) & (F.size(F.array_intersect("ka.t", "kb.t")) * 5 >= F.size(F.array_union("ka.t", "kb.t")) * 4)
    held = lambda i: side(i).join(pairs.select(i).distinct(), i, "left_semi")
    linked = pairs.join(held("a"), "a").join(held("b"), "b").where(alike).select("a", "b", F.col("ka.n").alias("na"), F.col("kb.n").alias("nb"))
    links = linked.select(F.explode(F.array(F.struct(F.col("a").alias("class_id"), F.col("nb").alias("n")), F.struct(F.col("b").alias("class_id"), F.col("na").alias("n")))).alias("x")).groupBy("x.class_id").agg(F.sum("x.n").alias("links"))
    counted = classes.select("h", "class_id", "n").join(links, "class_id", "left").select("h", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    return d.select("doc_id", "h").join(counted, "h").select("doc_id", "class_id", "links")


@query("""
SELECT d.doc_id, coalesce(nullif(c.text, ''), nullif(b.text, ''), nullif(d.text, '')) AS best_text, CASE WHEN coalesce(c.text, '') <> '' THEN 'thread' WHEN coalesce(b.text, '') <> '' THEN 'benchmark' ELSE 'caption' END AS origin
FROM documents d LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY 1) c ON c.conv_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def j20_first_filled_source(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min_by("text", "turn").alias("ct"))
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("bt"))
    d = table(spark, sf, "documents").select("doc_id", "text").join(c, "doc_id", "left").join(b, "doc_id", "left")
    return d.select("doc_id", R.first_filled(F.col("ct"), F.col("bt"), F.col("text")).alias("best_text"), F.when(~R.missing("ct"), "thread").when(~R.missing("bt"), "benchmark").otherwise("caption").alias("origin"))


@query("""
SELECT coalesce(n.c_custkey, o.c_custkey) AS username, coalesce(n.c_name, o.c_name) AS name, CASE WHEN n.c_custkey IS NOT NULL THEN 'new' ELSE 'kept' END AS origin
FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) o FULL OUTER JOIN (SELECT c_custkey, upper(c_name) AS c_name FROM customer WHERE c_custkey % 2 = 0) n ON n.c_custkey = o.c_custkey""")
def j21_profile_overlay(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    o, n = c.where("c_custkey % 3 <> 0").alias("o"), c.where("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("c_name")).alias("n")
    return o.join(n, F.col("o.c_custkey") == F.col("n.c_custkey"), "full_outer").select(F.coalesce("n.c_custkey", "o.c_custkey").alias("username"), F.coalesce("n.c_name", "o.c_name").alias("name"), F.when(F.col("n.c_custkey").isNotNull(), "new").otherwise("kept").alias("origin"))
