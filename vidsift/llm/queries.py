"""The subpackage's queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import decontam, mixing, panes, periodic, quality, secret_scan, simhash, suffix, tokenbin, tokencount, topk, toxicity, urlfilter
from .common import WORD


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda c: F.crc32(F.col(c).cast("string")) % 3
    model = quality.train(docs, labels.where(fold("doc_id") != 1))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urlfilter.RULES), "verdict string, host string, path string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_passages(table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda c: F.crc32(F.col(c).cast("string")) % 5
    model = toxicity.train(docs, labels.where(fold("doc_id") != 0))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents whose hash ends in 0 repeat one stretch of their words from word a to their end.

    With h the crc32 of the id and g = h // 10, word i >= a becomes word a + (i - a) % p of the original, where
    a = g % n and p = 1 + (n - a) // (3 + g % 8). Other documents, and those without id or words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    each = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), g.alias("g"))
    words = F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    each = each.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    each = each.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    each = each.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", source(i).cast("int")))
    return each.select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_periodic_ends(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(longer(best, r), r).otherwise(best))  # runs come by start, period
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


CLICK_BATCHES = 8


def click_batches(clicks: DataFrame) -> DataFrame:
    """(batch, kind, event_us, click_id, cents) of each click with a time, once: the least of rows that share an id.

    A click comes in the batch of its arrival day modulo 8, some of them later by their id's hash, and its event time is
    moved back by the same whole cycles of 8 days. Without arrival time, the event's day counts; rows without id are one
    click; values that are null or no finite number are 0 cents.
    """
    fields = F.struct("arrived_at", "ts", "kind", "value")
    once = clicks.where(F.col("ts").isNotNull()).groupBy("click_id").agg(F.min(fields).alias("x")).select("click_id", "x.*")
    day = F.unix_date(F.coalesce("arrived_at", "ts").cast("date"))
    q = F.pmod(day, F.lit(CLICK_BATCHES))
    delay = F.greatest(F.lit(0), F.coalesce(F.crc32(F.col("click_id").cast("string")), F.lit(0)) % 30 - 23)
    second = F.expr("extract(SECOND FROM ts)") * 1_000_000
    of_day = (F.hour("ts") * 60 + F.minute("ts")).cast("long") * 60_000_000 + second.cast("long")  # free of the session's zone
    event_us = (F.unix_date(F.col("ts").cast("date")) - day + q) * F.lit(panes.DAY_US) + of_day
    finite = F.abs("value") < F.lit(float("inf"))
    cents = F.when(finite, F.floor(100 * F.col("value") + 0.5)).otherwise(0)
    return once.select(F.least(F.lit(CLICK_BATCHES - 1), q + delay).cast("int").alias("batch"), "kind", event_us.cast("long").alias("event_us"), "click_id", cents.cast("long").alias("cents"))


def op13_pane_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panes.revisions(click_batches(table(spark, sf_dir, "clicks")), CLICK_BATCHES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_classifier, op2_source_mixing, op3_benchmark_decontamination, op4_token_shards, op5_simhash_near_duplicates, op6_url_filter, op7_repeated_passages, op8_exact_top_k, op9_token_counts, op10_secret_scan, op11_toxicity, op12_periodic_runs, op13_pane_revisions)
}

ORACLE_SQL: dict[str, str] = {
    "op2_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(length(regexp_replace(text, '[!-@\[-`{-~]+', '', 'g'))::DOUBLE / nullif(length(text), 0)::DOUBLE, 0.0) AS share,
         (('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, 'null'), ':17')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
k AS (SELECT doc_id, source, size, -ln(u) / greatest(share * share, 0.05) AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () AS total,
         sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 2 * source_size AS before_cap,
         sum(w) OVER () - sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) + w AS w_left
  FROM s),
l AS (
  SELECT arg_min(rate, cap::DOUBLE / w) AS rate FROM (SELECT *, (1.5 * total - before_cap)::DOUBLE / w_left::DOUBLE AS rate FROM r)
  WHERE rate * w <= cap),
t AS (
  SELECT source, source_size, CASE WHEN w * rate > cap THEN cap::DOUBLE ELSE w * rate END AS target FROM r, l),
p AS (
  SELECT k.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k)
SELECT doc_id, size, source_size, target,
       ((coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT
         + CASE WHEN before + size / 2.0 <= target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source""",
    "op6_url_filter": r"""
WITH r(action, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
u AS (SELECT page_id, row_number() OVER () AS n, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (
  SELECT p.n, max({'len': length(r.host || r.path), 'rule': r.host || r.path, 'action': r.action}) AS best
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.n)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM p LEFT JOIN m USING (n)""",
    "op8_exact_top_k": r"""
WITH i AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM i q JOIN i c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op13_pane_revisions": r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v
    FROM range(256) r(i))),
u AS (
  SELECT click_id, unnest(min({'arrived_at': arrived_at, 'ts': ts, 'kind': kind, 'value': value}))
  FROM clicks WHERE ts IS NOT NULL GROUP BY click_id),
h AS (
  SELECT u.*, date_diff('day', DATE '1970-01-01', coalesce(arrived_at, ts)::DATE) AS day,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(click_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                         lambda a, b: xor(a // 256, tab[(xor(a, b) & 255) + 1])), 4294967295) AS crc
  FROM u, tab),
d AS (
  SELECT click_id, coalesce(kind, 'none') AS kind, least(7, day % 8 + greatest(0, coalesce(crc, 0) % 30 - 23)) AS batch,
         epoch_us(ts) - (day - day % 8) * 86400000000 AS event_us,
         CASE WHEN isfinite(value) THEN floor(100 * value + 0.5)::BIGINT ELSE 0 END AS cents
  FROM h),
w AS (
  SELECT b AS batch, (SELECT max(event_us) FROM d WHERE d.batch < b) AS seen FROM range(8) r(b)),
e AS (
  SELECT d.*, floor(event_us / 3600000000.0)::BIGINT AS hour FROM d),
r AS (
  SELECT e.*, (hour + 1) * 3600000000 + 4 * 86400000000 <= coalesce(seen, -9e18) AS late FROM e JOIN w USING (batch)),
p AS (
  SELECT kind, hour, batch, count(*) AS n, sum(cents) AS c FROM r WHERE NOT late GROUP BY ALL),
due AS (
  SELECT kind, hour, min(w.batch) FILTER (WHERE w.batch >= first AND (hour + 1) * 3600000000 + 6 * 3600000000 <= coalesce(seen, -9e18)) AS due_at
  FROM (SELECT kind, hour, min(batch) AS first FROM p GROUP BY ALL) f, w GROUP BY ALL),
s AS (
  SELECT p.*, sum(n) OVER x AS all_n, sum(c) OVER x AS all_c, due.due_at
  FROM p JOIN due USING (kind, hour) WINDOW x AS (PARTITION BY kind, hour ORDER BY batch)),
o AS (
  SELECT batch, 'late' AS record, kind, hour, click_id, 1 AS n_rows, cents FROM r WHERE late
  UNION ALL
  SELECT coalesce(due_at, 7), CASE WHEN due_at IS NULL THEN 'final' ELSE 'emit' END, kind, hour, -1, max(all_n), arg_max(all_c, batch)
  FROM s WHERE due_at IS NULL OR batch <= due_at GROUP BY due_at, kind, hour
  UNION ALL
  SELECT batch, 'replace', kind, hour, -1, all_n, all_c FROM s WHERE batch > due_at
  UNION ALL
  SELECT batch, 'retract', kind, hour, -1, all_n - n, all_c - c FROM s WHERE batch > due_at)
SELECT batch::BIGINT AS batch, record, kind, hour::BIGINT AS hour, click_id::BIGINT AS click_id, n_rows::BIGINT AS n_rows, cents::BIGINT AS cents FROM o""",
}
