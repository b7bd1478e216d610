"""Scalar functions and text operators, each as a query of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import emoji as E
from ..functions import ocr as O
from ..functions import score as S
from ..functions import text as X
from ..functions import times as C
from ..operators import relational as R
from ..registry import query
from ..session import table
from .texts import EMOJI_SQL, frames, with_emoji

LINES_SQL = r"""list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\r\n?|\n?---\n?|\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"""


@query("SELECT event_type, round(avg(value), 2) AS mean, round(sum(value), 1) AS total, round(max(value), 0) AS top FROM events GROUP BY 1")
def a11_rounded_aggregates(spark, sf) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg("value"), 2).alias("mean"), F.round(F.sum("value"), 1).alias("total"), F.round(F.max("value"), 0).alias("top"))


@query("""
WITH c AS (SELECT s_suppkey AS pos, unnest([lower(s_name) || '_tv', lower(s_name)]) AS candidate, unnest([2, 1]) AS rank FROM supplier)
SELECT (row_number() OVER (ORDER BY pos, rank))::INTEGER AS place, candidate FROM c""")
def o05_source_order(spark, sf) -> DataFrame:
    """By the entry's place in the list, then the candidate's rank."""
    made = F.array(F.struct(F.lit(2).alias("rank"), F.concat(F.lower("s_name"), F.lit("_tv")).alias("candidate")), F.struct(F.lit(1).alias("rank"), F.lower("s_name").alias("candidate")))
    c = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("pos"), F.explode(made).alias("x")).select("pos", "x.rank", "x.candidate")
    return R.numbered(c, ["pos", "rank"], "place").select("place", "candidate")


@query("SELECT (o_orderkey // 100)::BIGINT AS batch, count(*)::BIGINT AS rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY 1")
def o07_id_batches(spark, sf) -> DataFrame:
    """Batches by id range, so no row number over all rows is needed."""
    return table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).alias("batch")).agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))


@query("SELECT event_id, value FROM events WHERE event_type = 'error' AND event_id < 5000 ORDER BY event_id LIMIT 20")
def o08_first_hits(spark, sf) -> DataFrame:
    """The first 20 hits among the first 5,000 entries: both limits are the feature."""
    return table(spark, sf, "events").where("event_id < 5000 and event_type = 'error'").select("event_id", "value").orderBy("event_id").limit(20)


@query("SELECT doc_id, length(text)::INTEGER AS chars FROM documents")
def f02_length(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("chars"))


@query("SELECT s_suppkey, trim('  ' || s_name || ' ') AS trimmed, lower(s_name) AS lowered, substr(s_name, 3, 5) AS part FROM supplier")
def f03_trim_lower_substr(spark, sf) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("s_name"), F.lit(" "))
    return table(spark, sf, "supplier").select("s_suppkey", F.trim(padded).alias("trimmed"), F.lower("s_name").alias("lowered"), F.substring("s_name", 3, 5).alias("part"))


@query("SELECT o_orderkey, round(o_totalprice, 1) AS one, round(o_totalprice / 7, 3) AS three FROM orders")
def f04_round(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.round("o_totalprice", 1).alias("one"), F.round(F.col("o_totalprice") / 7, 3).alias("three"))


@query("SELECT event_id, ts - INTERVAL 36 HOUR AS before, ts >= TIMESTAMP '2024-01-10 12:00:00' AS later FROM events")
def f06_timestamp_arithmetic(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.expr("ts - INTERVAL 36 HOURS").alias("before"), F.expr("ts >= timestamp_ntz'2024-01-10 12:00:00'").alias("later"))


@query("SELECT event_id, ts::DATE AS day FROM events")
def f08_date_of(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))


@query("SELECT o_orderkey FROM orders WHERE starts_with(o_orderpriority, '1-')")
def f09_starts_with(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where(F.startswith("o_orderpriority", F.lit("1-"))).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_type LIKE '%TIN%' OR p_name LIKE 'a_%'")
def f10_like(spark, sf) -> DataFrame:
    return table(spark, sf, "part").where(F.col("p_type").like("%TIN%") | F.col("p_name").like("a_%")).select("p_partkey")


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band FROM orders")
def f11_case_when(spark, sf) -> DataFrame:
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", F.when(p > 200000, "high").when(p > 100000, "mid").otherwise("low").alias("band"))


@query("SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), 'and')")
def f14_in_unnest(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").where(F.array_contains(F.split("text", " "), "and")).select("doc_id")


@query("SELECT event_id, substr(strftime(ts, '%Y-%m-%d %H:%M:%S'), 1, 10) AS day, strftime(ts - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before FROM events")
def f15_text_dates(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.substring(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1, 10).alias("day"), F.date_format(F.date_sub(F.to_date("ts"), 7), "yyyy-MM-dd").alias("week_before"))


@query("SELECT column_name AS name, ordinal_position::INTEGER - 1 AS place FROM information_schema.columns WHERE table_name = 'orders'")
def f16_table_columns(spark, sf) -> DataFrame:
    return spark.createDataFrame(list(enumerate(table(spark, sf, "orders").columns)), "place int, name string").select("name", "place")


@query("SELECT o_orderkey, least(100, greatest(0, o_totalprice / 2000 - 10)) AS clamped FROM orders")
def f18_clamp(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("o_totalprice") / 2000 - 10)).alias("clamped"))


@query("SELECT o_orderkey, ((o_orderkey - 500) % 7 + 7) % 7 AS wrapped, o_orderkey // 12 AS whole, round_even(o_orderkey / 4.0, 0)::BIGINT AS nearest FROM orders")
def f19_modulo_and_index(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.pmod(k - 500, F.lit(7)).alias("wrapped"), F.expr("o_orderkey div 12").alias("whole"), F.bround(k / 4.0).cast("long").alias("nearest"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 'E' WHEN 'view' THEN 'V' ELSE 'other' END AS alias FROM events")
def f20_map_lookup(spark, sf) -> DataFrame:
    names = F.create_map(F.lit("error"), F.lit("E"), F.lit("view"), F.lit("V"))
    return table(spark, sf, "events").select("event_id", F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("other")).alias("alias"))


@query(r"""
SELECT doc_id, regexp_matches(text, '(?i)\b(like|comment|share|follow|following|subscribers?|views?|for\s*you|fyp|live|sponsored|shop\s*now|learn\s*more|tiktok|capcut|duet|stitch\s*with)\b') AS chrome,
       regexp_matches(text, '(?i)\b(stitch|duet with|original sound)\b') AS stitch FROM documents""")
def f21_patterns(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.rlike("text", F.lit(O.UI_WORD)).alias("chrome"), F.rlike("text", F.lit(O.STITCH)).alias("stitch"))


@query("SELECT doc_id, true AS new_id, true AS now_is_set FROM documents")
def f22_run_identity(spark, sf) -> DataFrame:
    """A run's random id and instant differ each time, so what is compared is their form."""
    run = F.uuid()
    return table(spark, sf, "documents").select("doc_id", run.rlike("^[0-9a-f-]{36}$").alias("new_id"), F.current_timestamp().isNotNull().alias("now_is_set"))


@query("SELECT doc_id, true AS within FROM documents")
def f23_jitter(spark, sf) -> DataFrame:
    wait = F.lit(2.0) + F.rand(3)
    return table(spark, sf, "documents").select("doc_id", wait.between(2.0, 3.0).alias("within"))


@query("SELECT doc_id, unicode(text[1])::INTEGER AS point, 'U+' || lpad(upper(to_hex(unicode(text[1]))), 4, '0') AS shown FROM documents WHERE text <> ''")
def f24_code_points(spark, sf) -> DataFrame:
    first = F.substring("text", 1, 1)
    return table(spark, sf, "documents").where("text <> ''").select("doc_id", F.ascii(first).alias("point"), E.codepoints(first).alias("shown"))


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS compact, lpad((event_id % 100)::VARCHAR, 4, '0') AS padded FROM events")
def f26_date_text(spark, sf) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select("event_id", F.concat(F.substring(day, 1, 4), F.substring(day, 6, 2), F.substring(day, 9, 2)).alias("compact"), F.lpad((F.col("event_id") % 100).cast("string"), 4, "0").alias("padded"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN '' WHEN event_id % 2 = 0 THEN '[' || user_id || ',' || event_id || ']' ELSE event_type END AS field FROM events""")
def t12_json_field(spark, sf) -> DataFrame:
    """Scalars as they are, lists as JSON, nothing as empty text."""
    t = F.col("event_type")
    return table(spark, sf, "events").select("event_id", F.when(t == "error", "").when(F.col("event_id") % 2 == 0, F.to_json(F.array("user_id", "event_id"))).otherwise(t).alias("field"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'news|F|low' WHEN o_orderstatus = 'O' THEN 'news|O' ELSE 'news|P' END AS merged FROM orders")
def t14_merge_keywords(spark, sf) -> DataFrame:
    a, b = F.array(F.lit("news"), F.col("o_orderstatus")), F.when(F.col("o_orderstatus") == "F", F.array(F.lit("news"), F.lit("low"), F.lit("")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(X.merge_lists(a, b), "|").alias("merged"))


@query("""
SELECT d.doc_id, CASE WHEN d.text = b.text OR coalesce(b.text, '') = '' THEN d.text ELSE concat_ws(chr(10), b.text, d.text) END AS merged,
       CASE WHEN coalesce(b.text, '') = '' THEN 'ocr' WHEN d.text = b.text THEN 'sticker' ELSE 'sticker+ocr' END AS origin FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def t18_block_priority(spark, sf) -> DataFrame:
    """Sticker text before on-screen text; equal blocks once, sources joined by a plus sign."""
    d = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("b")), "doc_id", "left")
    none, same = R.missing("b"), F.col("b") == F.col("text")
    return d.select("doc_id", F.when(none | same, F.col("text")).otherwise(F.concat_ws("\n", "b", "text")).alias("merged"), F.when(none, "ocr").when(same, "sticker").otherwise("sticker+ocr").alias("origin"))


GLYPH_SQL = r"regexp_extract_all(coalesce(text, ''), '[\x{1F1E0}-\x{1F1FF}]{2}|[\x{1F300}-\x{1FAFF}][\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}]*|[\x{2600}-\x{27BF}]\x{FE0F}?')"


@query(f"""WITH g AS (SELECT doc_id, {GLYPH_SQL} AS g FROM documents) SELECT doc_id, len(g)::INTEGER AS n, coalesce(array_to_string(list_filter(g, lambda x, i: list_position(g, x) = i), ''), '') AS distinct_glyphs FROM g""")
def t20_emoji_string(spark, sf) -> DataFrame:
    g = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(E.GLYPHS), F.lit(0))
    return table(spark, sf, "documents").select("doc_id", F.size(g).alias("n"), F.array_join(F.array_distinct(g), "").alias("distinct_glyphs"))


@query(f"WITH {EMOJI_SQL} SELECT emoji, name AS emoji_name, sum(n)::BIGINT AS times FROM e LEFT JOIN known USING (emoji) GROUP BY 1, 2")
def t22_emoji_names(spark, sf) -> DataFrame:
    """The name of every glyph that the documents hold, and how often they hold it."""
    each = with_emoji(spark, sf).select(F.explode(E.glyphs(F.col("text"))).alias("emoji")).groupBy("emoji").agg(F.count("*").alias("times"))
    return each.join(F.broadcast(E.name_table(spark)), "emoji", "left").select("emoji", "emoji_name", "times")  # a fixed table of under 3,000 rows


@query(f"WITH {EMOJI_SQL} SELECT DISTINCT emoji, kind, category FROM e LEFT JOIN known USING (emoji)")
def t23_emoji_kinds(spark, sf) -> DataFrame:
    """Kind and category of every glyph that the documents hold, by its form and its name."""
    each = with_emoji(spark, sf).select(F.explode(E.glyphs(F.col("text"))).alias("emoji")).distinct()
    named = each.join(F.broadcast(E.name_table(spark)), "emoji", "left").withColumn("kind", E.kind(F.col("emoji")))  # a fixed table
    return named.select("emoji", "kind", E.category(F.col("kind"), F.coalesce("emoji_name", F.lit(""))).alias("category"))


@query(rf"""
WITH {EMOJI_SQL},
h AS (SELECT doc_id, s, length(s) AS n, string_split(s, '🔥') AS parts FROM x WHERE contains(s, '🔥')),
i AS (SELECT doc_id, s, unnest(generate_series(1, len(parts) - 1)) AS k, parts FROM h),
o AS (SELECT doc_id, s, length(array_to_string(parts[1:k], '🔥')) AS pos FROM i),
c AS (SELECT doc_id, list_filter(regexp_split_to_array(substr(s, greatest(1, pos - 79), least(80, pos)), '\s+'), lambda w: w <> '') AS b, list_filter(regexp_split_to_array(substr(s, pos + 2, 80), '\s+'), lambda w: w <> '') AS a FROM o),
w AS (SELECT doc_id, unnest(list_concat(b[-4:], a[:4])) AS w FROM c)
SELECT doc_id, string_agg(DISTINCT w, ' ' ORDER BY w) AS words FROM w GROUP BY 1""")
def t25_emoji_context(spark, sf) -> DataFrame:
    """The four words before and after each flame, within 80 characters, each once."""
    return E.context_words(with_emoji(spark, sf), "doc_id", F.col("text"), "🔥").select("doc_id", F.array_join(F.array_sort("words"), " ").alias("words"))


@query()
def t28_strip_marks(spark, sf) -> DataFrame:
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(X.text_lines(F.col("text"))).alias("line", "text"))
    return lines.select("doc_id", "line", O.strip_ui(F.col("text")).alias("stripped"))


@query()
def t29_persistent_phrases(spark, sf) -> DataFrame:
    return O.persistent_phrases(frames(spark, sf), "doc_id", "text")


@query()
def t30_strip_phrases(spark, sf) -> DataFrame:
    f = frames(spark, sf).select("doc_id", "frame", "text")
    return f.join(O.persistent_phrases(f, "doc_id", "text"), "doc_id", "left").select("doc_id", "frame", O.strip_phrases(F.col("text"), F.col("phrases")).alias("left_text"))


@query()
def t31_collapse(spark, sf) -> DataFrame:
    return O.collapse(frames(spark, sf), "doc_id", "frame", "text")


@query()
def t32_blocks_by_confidence(spark, sf) -> DataFrame:
    f = frames(spark, sf)
    return f.where(~O.garbage(F.col("text"), F.col("confidence"), 0.35)).select("doc_id", "frame", "confidence", "text")


@query(rf"""
WITH l AS (SELECT doc_id, list_transform({LINES_SQL}, lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))) AS k FROM documents)
SELECT doc_id, CASE WHEN len(k) = 0 THEN 0.0 ELSE round(len(list_distinct(k))::DOUBLE / len(k), 4) END AS ratio FROM l""")
def t33_unique_ratio(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", O.unique_ratio(X.text_lines(F.col("text"))).alias("ratio"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE least(100, 20 + CASE WHEN o_orderkey % 2 = 0 THEN 30 ELSE 0 END + CASE WHEN o_orderkey % 3 = 0 THEN 30 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 10 ELSE 0 END
       + CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 5 ELSE 0 END) END AS score FROM orders""")
def t40_enrichment_score(spark, sf) -> DataFrame:
    by = lambda n: F.col("o_orderkey") % n == 0
    return table(spark, sf, "orders").select("o_orderkey", S.enrichment_quality(~by(11), by(2), by(3), by(5), by(7), by(4)).alias("score"))


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN '' WHEN value > 100 THEN 'rate_limited' WHEN value > 60 THEN 'unauthorized' WHEN value > 30 THEN 'timeout' ELSE 'http_error' END AS code FROM events")
def t49_api_error_code(spark, sf) -> DataFrame:
    v = F.col("value")
    m = F.when(F.col("event_type") != "error", "").when(v > 100, "Rate limit reached").when(v > 60, "Unauthorised: 401").when(v > 30, "request timed out").otherwise("not found")
    return table(spark, sf, "events").select("event_id", X.api_error_code(m).alias("code"))


@query("""SELECT event_id, '$.data.items[1].props' AS path, 'key' AS match FROM events UNION ALL SELECT event_id, '$.data.kind', 'value' FROM events WHERE event_type = 'error'""")
def t51_json_search(spark, sf) -> DataFrame:
    """Paths of a JSON text whose key or text value holds the word looked for, whatever its depth."""
    j = F.when(F.col("event_type") == "error", F.lit('{"data":{"kind":"my props","items":[1,{"props":2}]}}')).otherwise(F.lit('{"data":{"kind":"none","items":[1,{"props":2}]}}'))
    return X.json_search(table(spark, sf, "events").select("event_id", j.alias("j")), "event_id", "j", "props")


@query("""SELECT event_id, 'u' || event_id || '|v' || user_id AS urls FROM events""")
def t52_caption_urls(spark, sf) -> DataFrame:
    """Caption urls under either of their names, each once, in order."""
    caption = lambda name, c: F.concat(F.lit(f'{{"{name}":"'), c, F.lit('","lang":"en"}'))
    u, v = F.concat(F.lit("u"), F.col("event_id").cast("string")), F.concat(F.lit("v"), F.col("user_id").cast("string"))
    j = F.concat(F.lit('{"captions":['), caption("url", u), F.lit(","), caption("downloadUrl", v), F.lit(","), caption("url", u), F.lit("]}"))
    listed = F.from_json(j, "captions array<struct<url:string,downloadUrl:string>>")["captions"]
    return table(spark, sf, "events").select("event_id", F.array_join(F.array_distinct(F.transform(listed, lambda x: F.coalesce(x["url"], x["downloadUrl"]))), "|").alias("urls"))


@query("""SELECT d.doc_id, coalesce(d.text, '') <> '' AS from_ocr, c.conv_id IS NOT NULL AS from_speech, concat_ws('+', CASE WHEN coalesce(d.text, '') <> '' THEN 'ocr' END, CASE WHEN c.conv_id IS NOT NULL THEN 'speech' END) AS origin
FROM documents d LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON conv_id = doc_id""")
def t54_provenance(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(True).alias("s")).distinct()
    ocr, speech = ~R.missing("text"), F.col("s").isNotNull()
    return table(spark, sf, "documents").select("doc_id", "text").join(c, "doc_id", "left").select("doc_id", ocr.alias("from_ocr"), speech.alias("from_speech"), F.concat_ws("+", F.when(ocr, "ocr"), F.when(speech, "speech")).alias("origin"))


@query(r"""SELECT doc_id, trim(regexp_replace(replace(text, chr(10), ' '), ' +', ' ', 'g')) AS read FROM (SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS text FROM documents)""")
def t58_reading_order(spark, sf) -> DataFrame:
    """Blocks (lines) of words, words joined by blanks, blocks in order."""
    blocks = F.transform(F.split("text", "\n"), lambda b: F.struct(F.filter(F.split(b, r"\s+"), lambda w: w != "").alias("words")))
    d = table(spark, sf, "documents").select("doc_id", blocks.alias("blocks"))
    return d.select("doc_id", F.array_join(F.filter(F.transform("blocks", lambda b: F.array_join(b["words"], " ")), lambda x: x != ""), " ").alias("read"))


@query(f"""
WITH {EMOJI_SQL}
SELECT doc_id, array_to_string(g, '') AS caption, coalesce(array_to_string(list_transform(list_filter(list_zip(g, generate_series(1, len(g))), lambda z: list_position(g, z[1]) = z[2]), lambda z: z[1]), ''), '') AS all_layers FROM g""")
def t59_export_emoji(spark, sf) -> DataFrame:
    """The glyphs of a document in order, and those of two layers together, each once."""
    g = with_emoji(spark, sf).select("doc_id", E.glyphs(F.col("text")).alias("g"))
    return g.select("doc_id", F.array_join("g", "").alias("caption"), F.array_join(F.array_distinct(F.concat("g", "g")), "").alias("all_layers"))


@query(r"""SELECT doc_id, len(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]{2,}')))::INTEGER AS tokens, CASE WHEN coalesce(text, '') = '' THEN 0.0 ELSE round(length(regexp_replace(text, '\P{L}', '', 'g'))::DOUBLE / length(text), 6) END AS letters FROM documents""")
def t62_text_shape(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(X.word_set(F.col("text"))).alias("tokens"), F.round(X.alpha_ratio(F.col("text")), 6).alias("letters"))


@query("""SELECT c_custkey, trim(split_part(c_name || ' + desk', '+', 1)) AS outlet, c_custkey % 10 = 0 AS header, list_filter(regexp_extract_all(lower(c_name || ' de la x'), '[a-z0-9]+'), lambda x: length(x) >= 2)[1] AS first_name, list_filter(regexp_extract_all(lower(c_name || ' de la x'), '[a-z0-9]+'), lambda x: length(x) >= 2)[-1] AS last_name FROM customer""")
def t64_outlet_and_person(spark, sf) -> DataFrame:
    """The outlet before a plus sign, whether a row is a header, the first and last name of two letters or more."""
    outlet = F.trim(F.substring_index(F.concat("c_name", F.lit(" + desk")), "+", 1))
    head = F.when(F.col("c_custkey") % 10 == 0, "Outlet name").otherwise(F.col("c_name"))
    names = F.filter(X.name_tokens(F.concat("c_name", F.lit(" de la x"))), lambda x: F.length(x) >= 2)
    return table(spark, sf, "customer").select("c_custkey", outlet.alias("outlet"), F.lower(head).startswith("outlet").alias("header"), F.get(names, F.lit(0)).alias("first_name"), F.element_at(names, -1).alias("last_name"))


@query("""
SELECT d.doc_id, CASE WHEN n_chars >= 500 THEN 'tier1' WHEN coalesce(b.text, '') <> '' THEN 'tier2' ELSE 'tier3' END AS tier,
       CASE WHEN n_chars >= 500 THEN d.text WHEN coalesce(b.text, '') <> '' AND b.text <> d.text THEN concat_ws(chr(10), d.text, b.text) ELSE d.text END AS visual FROM documents d LEFT JOIN benchmark b ON item_id = doc_id""")
def t66_tiered_text(spark, sf) -> DataFrame:
    """What a tier has found decides whether the next is asked; its text is merged with what there was."""
    d = table(spark, sf, "documents").select("doc_id", "text", "n_chars").join(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("b")), "doc_id", "left")
    enough, second = F.col("n_chars") >= 500, ~R.missing("b")
    return d.select("doc_id", F.when(enough, "tier1").when(second, "tier2").otherwise("tier3").alias("tier"), F.when(~enough & second & (F.col("b") != F.col("text")), F.concat_ws("\n", "text", "b")).otherwise(F.col("text")).alias("visual"))


@query("SELECT event_id, strftime(ts, '%Y%m%d') AS first_day, strftime(ts + INTERVAL 36 HOUR - INTERVAL 1 MICROSECOND, '%Y%m%d') AS last_day FROM events")
def c04_api_dates(spark, sf) -> DataFrame:
    a, b = C.api_dates(F.col("ts"), F.expr("ts + INTERVAL 36 HOURS"))
    return table(spark, sf, "events").select("event_id", a.alias("first_day"), b.alias("last_day"))


@query("SELECT event_id, (ts::DATE - 2) AS research_date FROM events")
def st5_lagged_research_date(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", C.lagged(F.col("ts").cast("timestamp"), 2, "UTC").alias("research_date"))


@query("""
WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, sum((event_type <> 'error')::INTEGER) OVER (PARTITION BY user_id ORDER BY event_id) AS island, event_type FROM events),
r AS (SELECT user_id, event_id, sum((event_type = 'error')::INTEGER) OVER (PARTITION BY user_id, island ORDER BY event_id) AS run FROM a)
SELECT user_id, min(event_id) AS stopped_at FROM r WHERE run >= 3 GROUP BY 1""")
def st7_circuit_breaker(spark, sf) -> DataFrame:
    """Where each collector's third failure in a row stops it."""
    s = R.streaks(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"], F.col("event_type") == "error")
    return s.where("in_a_row >= 3").groupBy("user_id").agg(F.min("event_id").alias("stopped_at"))


@query("SELECT s_suppkey, lower(regexp_replace(trim('@' || s_name), '^@+', '')) AS handle FROM supplier")
def x01_sql_functions(spark, sf) -> DataFrame:
    """A function defined in SQL, inlined by the optimiser, so it stays in the JVM."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION vidsift_handle(s STRING) RETURNS STRING RETURN lower(regexp_replace(trim(s), '^@+', ''))")
    return spark.sql("SELECT s_suppkey, vidsift_handle('@' || s_name) AS handle FROM {s}", s=table(spark, sf, "supplier"))
