"""Smaller text-layer, status, key and frame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ocr as O
from ..functions import score as S
from ..functions import text as X
from ..operators import relational as R
from ..registry import query
from ..session import table
from .texts import STOP, STOP_SQL, frames


@query("""
SELECT c_custkey, array_to_string(list_filter(list_transform(regexp_split_to_array(lower(c_mktsegment || '; @' || c_name || ', ' || c_mktsegment), '[,;/]'), lambda x: regexp_replace(trim(x), '^@+', '')), lambda x, i: list_position(list_transform(regexp_split_to_array(lower(c_mktsegment || '; @' || c_name || ', ' || c_mktsegment), '[,;/]'), lambda y: regexp_replace(trim(y), '^@+', '')), x) = i), '|') AS handles
FROM customer""")
def t09_masthead_split(spark, sf) -> DataFrame:
    raw = F.concat(F.col("c_mktsegment"), F.lit("; @"), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", F.array_join(X.split_list(raw), "|").alias("handles"))


@query(r"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\n'), lambda x: trim(x) <> ''))::BIGINT AS lines FROM documents""")
def t16_split_lines(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(X.text_lines(F.col("text"))).cast("long").alias("lines"))


@query()
def t36_segments(spark, sf) -> DataFrame:
    kept = O.dedupe_frames(frames(spark, sf), "doc_id", "frame", "text")
    detail = O.primary_source(F.col("text"))
    kind = F.when(detail == "video_overlay", "overlay").when(detail.isin("green_screen", "unknown"), detail).when(detail == "stitch_content", "stitch").otherwise("screenshot")
    return kept.select("doc_id", F.col("frame").alias("frame_number"), F.bround(F.least(F.lit(100.0), F.col("frame") * 100.0 / 12), 2).alias("frame_position"), kind.alias("source_type"), detail.alias("source_detail"))


@query()
def t39_labels_across_frames(spark, sf) -> DataFrame:
    each = frames(spark, sf).select("doc_id", "frame", O.source_labels(F.col("text")).alias("labels"))
    ordered = F.sort_array(F.collect_list(F.struct("frame", "labels")))
    return each.groupBy("doc_id").agg(F.to_json(F.array_distinct(F.flatten(ordered["labels"]))).alias("ocr_sources"))


@query("""
SELECT o_orderkey, CASE WHEN length(trim(coalesce(t, ''))) > 0 THEN 'ok' WHEN n > 0 THEN 'failed' ELSE 'missing' END AS ocr_status
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'text' WHEN o_orderkey % 3 = 1 THEN '  ' END AS t, o_orderkey % 4 AS n FROM orders)""")
def t42_ocr_status(spark, sf) -> DataFrame:
    t = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'text' WHEN o_orderkey % 3 = 1 THEN '  ' END")
    return table(spark, sf, "orders").select("o_orderkey", S.ocr_status(t, F.col("o_orderkey") % 4).alias("ocr_status"))


@query("""
WITH d AS (SELECT d.doc_id, n_chars >= 200 AS ocr, c.conv_id IS NOT NULL AS speech, strpos(text, '#') > 0 AS tags FROM documents d LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON conv_id = doc_id)
SELECT doc_id, concat_ws(',', CASE WHEN NOT ocr THEN 'ocr' END, CASE WHEN NOT speech THEN 'transcript' END, CASE WHEN NOT tags THEN 'hashtags' END) AS missing,
       CASE WHEN NOT ocr AND NOT speech THEN 'A' WHEN NOT ocr OR NOT speech THEN 'B' ELSE 'C' END AS priority,
       concat_ws('+', CASE WHEN NOT speech THEN 'whisper' END, CASE WHEN NOT ocr THEN 'ocr' END, CASE WHEN NOT ocr OR NOT speech THEN 'emoji' END) AS steps FROM d""")
def t43_retry_recommendation(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(True).alias("s")).distinct()
    d = table(spark, sf, "documents").join(c, "doc_id", "left").select("doc_id", (F.col("n_chars") >= 200).alias("o"), F.coalesce("s", F.lit(False)).alias("s"), (F.instr("text", "#") > 0).alias("h"))
    o, s, h = ~F.col("o"), ~F.col("s"), ~F.col("h")
    return d.select("doc_id", F.array_join(S.reasons((o, "ocr"), (s, "transcript"), (h, "hashtags")), ",").alias("missing"), F.when(o & s, "A").when(o | s, "B").otherwise("C").alias("priority"), F.array_join(S.reasons((s, "whisper"), (o, "ocr"), (o | s, "emoji")), "+").alias("steps"))


@query(f"""
SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z0-9]{{2,}}'), lambda x: x NOT IN {STOP_SQL}))::BIGINT AS tokens,
       len(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]{{2,}}')), lambda x: x NOT IN {STOP_SQL}))::BIGINT AS kinds FROM documents""")
def t45_word_tokens(spark, sf) -> DataFrame:
    every = F.filter(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]{2,}"), F.lit(0)), lambda x: ~x.isin(*STOP))
    return table(spark, sf, "documents").select("doc_id", F.size(every).cast("long").alias("tokens"), F.size(X.word_set(F.col("text"), STOP)).cast("long").alias("kinds"))


@query("""
SELECT doc_id, CASE WHEN n_chars = 0 THEN 'none' WHEN n_chars < 200 THEN 'caption' WHEN n_chars < 2000 THEN 'headline' ELSE 'document' END AS content_type,
       CASE WHEN n_chars < 80 THEN 'poor' WHEN strpos(text, '%%%') > 0 OR strpos(text, '&&&') > 0 THEN 'noisy' ELSE 'good' END AS quality,
       'chars=' || n_chars || '; lang=' || lang || '; source=' || source AS note FROM documents""")
def t47_content_heuristics(spark, sf) -> DataFrame:
    n = F.col("n_chars")
    kind = F.when(n == 0, "none").when(n < 200, "caption").when(n < 2000, "headline").otherwise("document")
    q = F.when(n < 80, "poor").when(F.instr("text", "%%%").cast("boolean") | F.instr("text", "&&&").cast("boolean"), "noisy").otherwise("good")
    return table(spark, sf, "documents").select("doc_id", kind.alias("content_type"), q.alias("quality"), F.format_string("chars=%d; lang=%s; source=%s", n, "lang", "source").alias("note"))


@query("""
SELECT event_id, value * 1.0 AS confidence, round(value, 1) >= 30 AS kept FROM events WHERE value >= 30 AND event_type <> 'error'""")
def t53_confidence_filter(spark, sf) -> DataFrame:
    return table(spark, sf, "events").where("value >= 30 and event_type <> 'error'").select("event_id", F.col("value").alias("confidence"), (F.round("value", 1) >= 30).alias("kept"))


@query("""
SELECT d.doc_id, length(text)::BIGINT AS ocr_chars, coalesce(length(c.t), 0)::BIGINT AS speech_chars, coalesce(c.t, '') = '' AS fallback, CASE WHEN coalesce(c.t, '') <> '' THEN 'speech' ELSE 'ocr' END AS origin
FROM documents d LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS t FROM conversations GROUP BY 1) c ON conv_id = doc_id""")
def t55_layer_lengths(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min_by("text", "turn").alias("t"))
    d = table(spark, sf, "documents").select("doc_id", "text").join(c, "doc_id", "left")
    return d.select("doc_id", F.length("text").cast("long").alias("ocr_chars"), F.coalesce(F.length("t"), F.lit(0)).cast("long").alias("speech_chars"), R.missing("t").alias("fallback"), F.when(~R.missing("t"), "speech").otherwise("ocr").alias("origin"))


@query("""
SELECT user_id, count_if(event_type IN ('view', 'click'))::BIGINT AS voiced, count(*) AS frames, count_if(event_type IN ('view', 'click')) / count(*)::DOUBLE >= 0.10 AS speech FROM events GROUP BY 1""")
def t56_speech_ratio(spark, sf) -> DataFrame:
    v = F.count_if(F.col("event_type").isin("view", "click"))
    return table(spark, sf, "events").groupBy("user_id").agg(v.alias("voiced"), F.count("*").alias("frames"), (v / F.count("*") >= 0.10).alias("speech"))


@query("""
SELECT doc_id, array_to_string(list_sort(list_distinct([0, round_even((n - 1) * 0.25, 0)::BIGINT, round_even((n - 1) * 0.5, 0)::BIGINT, round_even((n - 1) * 0.75, 0)::BIGINT, n - 1])), ',') AS picked
FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents)""")
def t57_frame_selection(spark, sf) -> DataFrame:
    """Frames at the quartiles of a video, each once: a document is a video, its lines are the frames."""
    v = table(spark, sf, "documents").select("doc_id", F.size(F.split("text", "\n")).alias("n"))
    at = F.transform(F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]), lambda p: F.bround((F.col("n") - 1) * p, 0).cast("long"))
    return v.select("doc_id", F.array_join(F.array_sort(F.array_distinct(at)).cast("array<string>"), ",").alias("picked"))


@query("""SELECT doc_id, lower(lang) || '|' || source AS candidate_key, source || '|' || doc_id || '|' || (doc_id + 1) AS unit_key, split_part(source || ' + x', ' + ', 1) AS outlet FROM documents""")
def t63_composite_keys(spark, sf) -> DataFrame:
    unit = F.concat_ws("|", "source", F.col("doc_id").cast("string"), (F.col("doc_id") + 1).cast("string"))
    return table(spark, sf, "documents").select("doc_id", F.concat_ws("|", F.lower("lang"), "source").alias("candidate_key"), unit.alias("unit_key"), X.strip(F.substring_index(F.concat(F.col("source"), F.lit(" + x")), "+", 1)).alias("outlet"))


@query("""
SELECT event_id, coalesce(try_cast(nullif(CASE WHEN event_id % 3 = 0 THEN '77' WHEN event_id % 3 = 1 THEN 'bad' END, '') AS BIGINT), event_id % 100) AS quality,
       concat_ws(' ', CASE WHEN event_type = 'error' THEN 'http_error' END, CASE WHEN event_type = 'error' THEN 'HTTP 500' END, props) AS page_error FROM events""")
def t65_stored_else_computed(spark, sf) -> DataFrame:
    stored = F.expr("CASE WHEN event_id % 3 = 0 THEN '77' WHEN event_id % 3 = 1 THEN 'bad' END")
    bad = F.col("event_type") == "error"
    return table(spark, sf, "events").select("event_id", F.coalesce(stored.try_cast("long"), F.col("event_id") % 100).alias("quality"), F.concat_ws(" ", F.when(bad, "http_error"), F.when(bad, "HTTP 500"), "props").alias("page_error"))


@query("""
SELECT conv_id, turn, 'c' || conv_id || '_' || turn AS comment_id, coalesce(text, '') AS text, CASE WHEN turn = 0 THEN '' ELSE 'c' || conv_id || '_' || (turn - 1) END AS parent_comment_id, coalesce(role, 'unknown') AS commenter FROM conversations""")
def t60_comment_normalise(spark, sf) -> DataFrame:
    cid = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), t.cast("string"))
    return table(spark, sf, "conversations").select("conv_id", "turn", cid(F.col("turn")).alias("comment_id"), F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("turn") == 0, "").otherwise(cid(F.col("turn") - 1)).alias("parent_comment_id"), F.coalesce("role", F.lit("unknown")).alias("commenter"))


@query("""
SELECT c_custkey, coalesce(c_name, '') AS display_name, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS followers, (c_acctbal < 0)::INTEGER AS api_failed, CASE WHEN c_acctbal < 0 THEN 'failed' WHEN c_acctbal = 0 THEN 'not_found' ELSE 'found' END AS lookup FROM customer""")
def s13_profile_defaults(spark, sf) -> DataFrame:
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", F.coalesce("c_name", F.lit("")).alias("display_name"), F.when(b < 0, 0.0).otherwise(b).alias("followers"), (b < 0).cast("int").alias("api_failed"), F.when(b < 0, "failed").when(b == 0, "not_found").otherwise("found").alias("lookup"))


@query("SELECT doc_id, 0 AS frame_number, text AS ocr_text, NULL::DOUBLE AS confidence, 'web' AS source FROM documents WHERE coalesce(text, '') <> ''")
def s25_web_text_frame(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").where(~R.missing("text"))
    return d.select("doc_id", F.lit(0).alias("frame_number"), F.col("text").alias("ocr_text"), F.lit(None).cast("double").alias("confidence"), F.lit("web").alias("source"))


@query("""SELECT o_orderstatus AS collection_status, o_orderkey::VARCHAR AS video_id, coalesce(string_agg(l_returnflag, '|' ORDER BY l_linenumber, l_returnflag), '') AS flags FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def k20_csv_shape(spark, sf) -> DataFrame:
    from ..sources.writers import csv_shape

    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    o = R.with_children(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), li, "o_orderkey", ["l_linenumber", "l_returnflag"], ["l_linenumber", "l_returnflag"], "kids")
    d = o.select(F.col("o_orderkey").alias("video_id"), F.col("o_orderstatus").alias("collection_status"), F.col("kids.l_returnflag").alias("flags"))
    return csv_shape(d, ["collection_status", "video_id"])


@query("""
SELECT event_id FROM events WHERE epoch(ts) >= epoch(TIMESTAMP '2024-01-10') AND epoch(ts) < epoch(TIMESTAMP '2024-01-11')""")
def c07_window_membership(spark, sf) -> DataFrame:
    unix = F.unix_micros(F.col("ts").cast("timestamp"))
    a, b = (F.unix_micros(F.lit(d).cast("timestamp")) for d in ("2024-01-10", "2024-01-11"))
    return table(spark, sf, "events").where((unix >= a) & (unix < b)).select("event_id")


@query("""
SELECT doc_id, place::INTEGER AS place, CASE WHEN code IN ('en', 'de', 'web') THEN code ELSE 'unsure' END AS label
FROM (SELECT doc_id, unnest([lang, source, '??']) AS code, unnest([0, 1, 2]) AS place FROM documents WHERE doc_id % 5 <> 0)""")
def t61_label_responses(spark, sf) -> DataFrame:
    """Labels of JSON lists in their order, every third fenced, every fifth cut short; codes that are not known become unsure."""
    whole = F.to_json(F.array(F.col("lang"), F.col("source"), F.lit("??")))
    n = F.col("doc_id")
    raw = F.when(n % 5 == 0, F.left(whole, F.length(whole) - 1)).when(n % 3 == 0, F.concat(F.lit("```json\n"), whole, F.lit("\n```"))).otherwise(whole)
    codes = F.from_json(X.unfenced_json(raw), "array<string>")
    each = table(spark, sf, "documents").select("doc_id", F.posexplode(codes).alias("place", "code"))
    return each.select("doc_id", "place", F.when(F.col("code").isin("en", "de", "web"), F.col("code")).otherwise("unsure").alias("label"))


@query("""
SELECT d.doc_id, coalesce(f.t, d.source) AS onscreen, coalesce(nullif(CASE WHEN l.quality = 1 THEN c.t END, ''), d.lang) AS transcript FROM documents d
LEFT JOIN (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS t FROM conversations GROUP BY 1) f ON f.conv_id = d.doc_id
LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS t FROM conversations GROUP BY 1) c ON c.conv_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def t67_emoji_inputs(spark, sf) -> DataFrame:
    """Frames joined by line breaks; a transcript counts only where its status is ok."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "text")))
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(listed["text"], "\n").alias("f"), F.min_by("text", "turn").alias("t"))
    d = table(spark, sf, "documents").select("doc_id", "source", "lang").join(c, "doc_id", "left").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", F.coalesce("f", "source").alias("onscreen"), R.first_filled(F.when(F.col("quality") == 1, F.col("t")), F.col("lang")).alias("transcript"))
