"""Text layers, handles, candidates, emoji and on-screen text as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import emoji as E
from ..functions import ocr as O
from ..functions import score as S
from ..functions import text as X
from ..operators import relational as R
from ..registry import query
from ..session import table


@query(r"""SELECT s_suppkey, lower(regexp_replace(trim('  @@' || s_name || ' '), '^@+', '')) AS handle FROM supplier""")
def t01_handle_normalise(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", X.handle(F.concat(F.lit("  @@"), F.col("s_name"), F.lit(" "))).alias("handle"))


PROFILE = "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://www.example.com/@Some.' || page_id || '/video/3?x=1' ELSE ' @Name_' || page_id || ' bad' END"


@query(rf"""
WITH r AS (SELECT page_id, {PROFILE} AS raw FROM pages),
u AS (SELECT page_id, raw, lower(trim(CASE WHEN contains(raw, '@') THEN split_part(regexp_split_to_array(split_part(raw, '@', 2), '[/?#]')[1], ' ', 1) ELSE regexp_split_to_array(raw, '[/?#]')[-1] END)) AS u FROM r)
SELECT page_id, raw, CASE WHEN regexp_full_match(u, '[a-z0-9._]+') THEN u ELSE '' END AS username FROM u""")
def t02_username_from_url(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.expr(PROFILE).alias("raw")).withColumn("username", X.username_from(F.col("raw")))


@query("""
WITH t AS (SELECT p_partkey, list_filter(regexp_extract_all(lower(p_name), '[a-z0-9]+'), lambda x: x NOT IN ('the', 'and', 'of')) AS k FROM part)
SELECT p_partkey, array_to_string(k, '') AS joined, array_to_string(k, '_') AS lined, len(k)::INTEGER AS n FROM t""")
def t03_name_slugs(spark, sf) -> DataFrame:
    k = X.name_tokens(F.col("p_name"), ("the", "and", "of"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(k, "").alias("joined"), F.array_join(k, "_").alias("lined"), F.size(k).alias("n"))


@query(r"""
WITH h AS (SELECT page_id, url, string_split(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#:\s]+)', 1)), '.') AS p FROM pages)
SELECT page_id, array_to_string(p, '.') AS host, CASE WHEN len(p) < 2 THEN '' WHEN len(p) >= 3 AND p[len(p) - 1] = 'go' THEN p[len(p) - 2] ELSE p[len(p) - 1] END AS slug FROM h""")
def t04_domain_slug(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.host(F.col("url")).alias("host"), X.domain_slug(F.col("url")).alias("slug"))


@query("""
WITH t AS (SELECT s_suppkey, list_filter(regexp_extract_all(lower(s_name), '[a-z0-9]+'), lambda x: x <> 'the') AS k FROM supplier),
m AS (SELECT s_suppkey, list_filter([array_to_string(k, '_'), array_to_string(k, ''), array_to_string(k, '') || 'news', array_to_string(k, '') || 'tv', array_to_string(k, '') || 'reporter'], lambda x: length(x) >= 4) AS c FROM t)
SELECT s_suppkey, (generate_subscripts(c, 1) - 1)::INTEGER AS place, unnest(c) AS candidate FROM (SELECT s_suppkey, list_filter(c, lambda x, i: list_position(c, x) = i)[1:5] AS c FROM m)""")
def t05_candidates(spark, sf) -> DataFrame:
    c = X.candidates(X.name_tokens(F.col("s_name"), ("the",)), ("news", "tv", "reporter"), 4, 5)
    return table(spark, sf, "supplier").select("s_suppkey", F.posexplode(c).alias("place", "candidate"))


@query("""
SELECT c_custkey, (CASE WHEN c_custkey % 5 = 0 THEN 50 ELSE 0 END + CASE WHEN c_acctbal > 5000 THEN 25 ELSE 0 END + CASE WHEN c_mktsegment = 'MACHINERY' THEN 15 ELSE 0 END)::INTEGER AS score,
       coalesce(CASE WHEN c_custkey % 5 = 0 THEN 'exact_x_handle' END, CASE WHEN c_acctbal > 5000 THEN 'followers' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'outlet_in_bio' END, 'none') AS primary_reason,
       concat_ws(',', CASE WHEN c_custkey % 5 = 0 THEN 'exact_x_handle' END, CASE WHEN c_acctbal > 5000 THEN 'followers' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'outlet_in_bio' END) AS reasons,
       c_custkey % 5 = 0 AS high_confidence FROM customer""")
def t06_evidence_score(spark, sf) -> DataFrame:
    table_ = (("exact_x_handle", 50, F.col("c_custkey") % 5 == 0), ("followers", 25, F.col("c_acctbal") > 5000), ("outlet_in_bio", 15, F.col("c_mktsegment") == "MACHINERY"))
    why = S.reasons(*[(c, n) for n, _, c in table_])
    score = sum((S.points(c, p) for _, p, c in table_), F.lit(0))
    return table(spark, sf, "customer").select("c_custkey", score.alias("score"), F.coalesce(F.get(why, F.lit(0)), F.lit("none")).alias("primary_reason"), F.array_join(why, ",").alias("reasons"), ((score >= 50) & F.array_contains(why, "exact_x_handle")).alias("high_confidence"))


@query("SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS folded FROM documents")
def t08_fold_text(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.fold(F.col("text")).alias("folded"))


@query(r"""
SELECT d.doc_id, concat_ws(chr(10) || '---' || chr(10), nullif(regexp_replace(d.text, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(c.text, '^\s+|\s+$', '', 'g'), '')) AS nlp
FROM documents d LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY 1) c ON conv_id = doc_id""")
def t10_nlp_text(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min_by("text", "turn").alias("said"))
    return table(spark, sf, "documents").select("doc_id", "text").join(c, "doc_id", "left").select("doc_id", X.nlp_text(F.col("text"), F.col("said")).alias("nlp"))


STICKERS = """CASE WHEN s_suppkey % 7 = 5 THEN 'bad' WHEN s_suppkey % 4 = 3 THEN '[]' WHEN s_suppkey % 11 = 6 THEN NULL ELSE '[{"sticker_name":"  ' || s_name || ' "},{"sticker_name":""},{"sticker_name":"N' || s_nationkey || '"}]' END"""


@query(f"""
WITH r AS (SELECT s_suppkey, {STICKERS} AS raw FROM supplier)
SELECT s_suppkey, raw, CASE WHEN json_valid(raw) THEN array_to_string(list_filter(list_transform(json_extract_string(CASE WHEN json_valid(raw) THEN raw ELSE '[]' END, '$[*].sticker_name'), lambda x: trim(x)), lambda x: x <> ''), ' | ') END AS stickers FROM r""")
def t11_sticker_text(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", F.expr(STICKERS).alias("raw")).withColumn("stickers", X.sticker_text(F.col("raw")))


KEYWORDS = """CASE p_partkey % 5 WHEN 0 THEN '["' || p_name || '","News","' || upper(p_name) || '"]' WHEN 1 THEN upper(p_name) || ', ice ,,ICE,' || p_type WHEN 2 THEN p_name WHEN 3 THEN '' END"""


@query(f"""
WITH r AS (SELECT p_partkey, {KEYWORDS} AS raw FROM part),
c AS (SELECT p_partkey, raw, list_filter(list_transform(CASE WHEN starts_with(raw, '[') THEN json_extract_string(CASE WHEN starts_with(raw, '[') THEN raw ELSE '[]' END, '$[*]') ELSE string_split(coalesce(raw, ''), ',') END, lambda x: lower(trim(x))), lambda x: x <> '') AS c FROM r)
SELECT p_partkey, raw, array_to_string(list_filter(c, lambda x, i: list_position(c, x) = i), '|') AS keywords FROM c""")
def t13_keyword_list(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.expr(KEYWORDS).alias("raw")).withColumn("keywords", F.array_join(X.keyword_list(F.col("raw")), "|"))


@query(r"""
SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n?-{3,}\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')) AS visual
FROM documents""")
def t15_normalise_lines(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.visual_text(F.col("text")).alias("visual"))


@query(r"""
WITH l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines FROM documents),
k AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l),
f AS (SELECT doc_id, arg_min(line, i) AS line, min(i) AS i FROM k GROUP BY doc_id, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))))
SELECT l.doc_id, coalesce(m.merged, '') AS merged, coalesce(m.n, 0) AS n FROM l LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS merged, count(*) AS n FROM f GROUP BY 1) m USING (doc_id)""")
def t17_merge_layers(spark, sf) -> DataFrame:
    """Sticker text is the first half of the lines, on-screen text all of them; equal lines are kept once."""
    lines = X.text_lines(F.col("text"))
    half = F.array_join(F.slice(lines, F.lit(1), F.greatest(F.lit(1), F.size(lines) / 2).cast("int")), "\n")
    m = X.merge_layers(table(spark, sf, "documents"), "doc_id", ("sticker", half), ("onscreen", F.col("text")))
    return m.select("doc_id", F.array_join(F.col("lines.line"), "\n").alias("merged"), F.size("lines").cast("long").alias("n"))


@query(r"""
WITH l AS (SELECT doc_id, source, list_distinct(list_transform(list_filter(regexp_split_to_array(text, '\n'), lambda x: trim(x) <> ''), lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g'))))) AS k FROM documents)
SELECT a.doc_id, b.doc_id AS other, CASE WHEN len(a.k) + len(b.k) = 0 THEN 1.0 ELSE round(len(list_intersect(a.k, b.k))::DOUBLE / len(list_distinct(list_concat(a.k, b.k))), 4) END AS overlap
FROM l a JOIN l b ON b.doc_id = a.doc_id + 1""")
def t19_line_jaccard(spark, sf) -> DataFrame:
    k = F.array_distinct(F.transform(X.text_lines(F.col("text")), X.line_key))
    d = table(spark, sf, "documents").select("doc_id", k.alias("k"))
    b = d.select(F.col("doc_id").alias("other"), F.col("k").alias("kb"))
    return d.join(b, F.col("other") == F.col("doc_id") + 1).select("doc_id", "other", F.round(X.jaccard(F.col("k"), F.col("kb"), 1.0), 4).alias("overlap"))


#: Emoji by a document's number: emotions, a flag, a glyph with a selector, a mark and a symbol that no rule counts.
EMOJI = ("🔥", "😂", "❤️", "🇺🇸", "🧊", "🚨", "☀", "✔", "")
#: What the Unicode names say of the glyphs, for the SQL.
EMOJI_SQL = f"""
t AS (SELECT doc_id, [{", ".join(f"'{g}'" for g in EMOJI)}] AS p, coalesce(text, '') AS text FROM documents),
x AS (SELECT doc_id, p[(doc_id % 9 + 1)::INTEGER] || ' ' || text || ' ' || p[(doc_id // 9 % 9 + 1)::INTEGER] || p[(doc_id % 9 + 1)::INTEGER] AS s FROM t),
g AS (SELECT doc_id, s, list_filter(regexp_extract_all(s, '{E.GLYPHS}'), lambda y: NOT regexp_matches(y, '{E._class(E.MARKS + E.JOINERS)}')) AS g FROM x),
known(emoji, kind, category, name, codepoint) AS (VALUES ('🔥', 'emoji', 'emphasis', 'fire', 'U+1F525'), ('😂', 'emoji', 'emotion', 'face with tears of joy', 'U+1F602'), ('🇺🇸', 'flag', 'flag', 'flag United States', 'U+1F1FA U+1F1F8'),
  ('🧊', 'emoji', 'object', 'ice cube', 'U+1F9CA'), ('🚨', 'emoji', 'object', 'police car light', 'U+1F6A8'), ('☀', 'symbol', 'symbol', 'black sun with rays', 'U+2600')),
e AS (SELECT doc_id, emoji, count(*) AS n FROM (SELECT doc_id, unnest(g) AS emoji FROM g) GROUP BY 1, 2)"""


def with_emoji(spark, sf) -> DataFrame:
    """(doc_id, text): whole documents with glyphs before and behind them, by the document's number."""
    p, n = F.array(*map(F.lit, EMOJI)), F.col("doc_id")
    at = lambda i: F.get(p, (i % len(EMOJI)).cast("int"))
    text = F.concat(at(n), F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "), at(F.floor(n / len(EMOJI))), at(n))
    return table(spark, sf, "documents").select("doc_id", text.alias("text"))


@query(f"""
WITH {EMOJI_SQL}
SELECT doc_id, 'caption' AS text_source, emoji, n AS count, kind AS emoji_kind, name AS emoji_name, category AS emoji_category, codepoint AS emoji_codepoint FROM e LEFT JOIN known USING (emoji) WHERE kind IS DISTINCT FROM 'symbol'""")
def t24_emoji_rows(spark, sf) -> DataFrame:
    return E.emoji_rows(with_emoji(spark, sf), "doc_id", {"caption": F.col("text")})


@query(f"""
WITH {EMOJI_SQL},
l AS (SELECT doc_id, list(emoji ORDER BY n DESC, emoji) AS e, list(name ORDER BY n DESC, emoji) AS names, list(category ORDER BY n DESC, emoji) AS c, sum(2 * n)::BIGINT AS total FROM e JOIN known USING (emoji) WHERE kind <> 'symbol' GROUP BY 1)
SELECT doc_id, array_to_string(e, ' | ') AS emoji_characters, array_to_string(names, ' | ') AS emoji_descriptions,
       array_to_string(list_transform(list_filter(list_zip(c, generate_series(1, len(c))), lambda z: list_position(c, z[1]) = z[2]), lambda z: z[1]), ' | ') AS emoji_category, 'caption | hashtags' AS emoji_source, total AS emoji_count FROM l""")
def t21_emoji_rollup(spark, sf) -> DataFrame:
    return E.rollup(E.emoji_rows(with_emoji(spark, sf), "doc_id", {"caption": F.col("text"), "hashtags": F.col("text")}), "doc_id")


@query(r"""
WITH d AS (SELECT doc_id, text AS t, length(text) AS n, len(list_filter(regexp_split_to_array(text, '\n'), lambda x: trim(x) <> '')) AS lines FROM documents),
f AS (SELECT *, regexp_matches(t, '(?i)\b(twitter|repost(?:ed)?|retweet|quote\s*tweet|followers?|following)\b|\bx\.com\b|@\w{2,}|\b\d+\s*[mhd]\b.*@') AS tw,
  regexp_matches(t, '(?i)\b(source:\s*|al\s*jazeera|reuters|associated\s*press|\bap\b|times of israel|cnn|bbc|minutes?\s*read|file:\s*)') AS nw FROM d)
SELECT doc_id, tw AS twitter, nw AS news, (lines >= 4 AND n > 120 AND NOT tw AND NOT nw) AS screenshot FROM f""")
def t37_sources(spark, sf) -> DataFrame:
    labels = O.source_labels(F.col("text"))
    has = lambda v: F.array_contains(labels, v)
    return table(spark, sf, "documents").select("doc_id", has("twitter_screenshot").alias("twitter"), has("news_screenshot").alias("news"), has("screenshot").alias("screenshot"))


@query()
def t38_primary_source(spark, sf) -> DataFrame:
    labelled = table(spark, sf, "documents").select("doc_id", O.source_labels(F.col("text")).alias("labels"))
    return labelled.select("doc_id", O.primary_of(F.col("labels")).alias("primary_source"), F.to_json("labels").alias("ocr_sources"))


@query()
def t26_clean_text(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", O.clean(F.col("text")).alias("cleaned"))


@query()
def t27_garbage(spark, sf) -> DataFrame:
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(X.text_lines(F.col("text"))).alias("line", "text"))
    return lines.select("doc_id", "line", O.garbage(F.col("text")).alias("garbage"))


@query()
def t34_quality(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text", X.text_lines(F.col("text")).alias("lines"))
    ratio = F.bround(F.try_divide(F.size(F.array_distinct(F.transform("lines", X.line_key))).cast("double"), F.size("lines")), 4)
    d = d.select("doc_id", "text", F.coalesce(ratio, F.lit(0.0)).alias("ratio"), F.size(O.source_labels(F.col("text"))).alias("sources"), F.size("lines").alias("frames"))
    return d.select("doc_id", O.quality_score(F.col("text"), F.col("text"), F.col("ratio"), F.col("sources"), F.col("frames"), F.lit(1)).alias("ocr_quality_score"))


def frames(spark, sf) -> DataFrame:
    """Lines of a document as its frames."""
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(X.text_lines(F.col("text"))).alias("frame", "text"))
    return d.withColumn("confidence", (F.pmod(F.hash("text"), F.lit(100)) / 100.0))


@query()
def t35_frame_dedupe(spark, sf) -> DataFrame:
    return O.dedupe_frames(frames(spark, sf), "doc_id", "frame", "text")


@query()
def a22_ocr_rollup(spark, sf) -> DataFrame:
    return O.rollup(frames(spark, sf), "doc_id", "frame", "text", "confidence")


STOP = ("the", "and", "of", "to", "in", "is", "it", "for")
STOP_SQL = "('the', 'and', 'of', 'to', 'in', 'is', 'it', 'for')"


@query(f"""
WITH s AS (SELECT d.doc_id, list_filter(list_distinct(regexp_extract_all(lower(d.text), '[a-z0-9]{{2,}}')), lambda x: x NOT IN {STOP_SQL}) AS o,
  list_filter(list_distinct(regexp_extract_all(lower(coalesce(c.text, '')), '[a-z0-9]{{2,}}')), lambda x: x NOT IN {STOP_SQL}) AS v
  FROM documents d LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY 1) c ON conv_id = doc_id),
m AS (SELECT doc_id, len(o) AS n, len(list_intersect(o, v)) AS both_n, len(list_distinct(list_concat(o, v))) AS either FROM s)
SELECT doc_id, round(CASE WHEN either = 0 THEN 0.0 ELSE both_n::DOUBLE / either END, 4) AS overlap, round(CASE WHEN n = 0 THEN 0.0 ELSE (n - both_n)::DOUBLE / n END, 4) AS novelty FROM m""")
def t46_text_novelty(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min_by("text", "turn").alias("said"))
    d = table(spark, sf, "documents").select("doc_id", "text").join(c, "doc_id", "left").select("doc_id", X.word_set(F.col("text"), STOP).alias("o"), X.word_set(F.col("said"), STOP).alias("v"))
    novel = F.coalesce(F.try_divide(F.size(F.array_except("o", "v")).cast("double"), F.size("o")), F.lit(0.0))
    return d.select("doc_id", F.round(X.jaccard(F.col("o"), F.col("v"), 0.0), 4).alias("overlap"), F.round(novel, 4).alias("novelty"))


@query(r"""
WITH u AS (SELECT lang, CASE WHEN n_chars < 200 THEN 'short' WHEN strpos(text, '|') > 0 THEN 'list' ELSE 'prose' END AS kind, CASE WHEN l.quality = 1 THEN 'useful' WHEN l.quality = 0 THEN 'noise' ELSE 'unknown' END AS bucket FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT lang, kind, count_if(bucket = 'useful')::BIGINT AS useful, count_if(bucket = 'noise')::BIGINT AS noise, count_if(bucket = 'unknown')::BIGINT AS unknown FROM u GROUP BY 1, 2""")
def a30_usefulness(spark, sf) -> DataFrame:
    kind = F.when(F.col("n_chars") < 200, "short").when(F.instr("text", "|") > 0, "list").otherwise("prose")
    q = F.col("quality")
    d = table(spark, sf, "documents").select("doc_id", "lang", kind.alias("kind")).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.groupBy("lang", "kind").agg(F.count_if(q == 1).alias("useful"), F.count_if(q == 0).alias("noise"), F.count_if(q.isNull()).alias("unknown"))


@query("""
WITH s AS (SELECT d.doc_id, n_chars >= 300 AS ocr, c.conv_id IS NOT NULL AS speech, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON conv_id = doc_id),
r AS (SELECT *, concat_ws(' | ', CASE WHEN toxic = 1 THEN 'transcript:toxic' END, CASE WHEN quality = 0 THEN 'ocr:low quality' END) AS why FROM s)
SELECT doc_id, CASE WHEN ocr AND speech THEN CASE WHEN why = '' THEN 'ok' ELSE 'partial' END WHEN ocr OR speech THEN CASE WHEN why = '' AND speech THEN 'ok' ELSE 'partial' END WHEN why <> '' THEN 'failed' ELSE 'partial' END AS status, why AS reason FROM r""")
def t41_status_machine(spark, sf) -> DataFrame:
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(True).alias("speech")).distinct()
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") >= 300).alias("ocr")).join(table(spark, sf, "labels"), "doc_id", "left").join(c, "doc_id", "left").withColumn("speech", F.coalesce("speech", F.lit(False)))
    why = S.reasons((F.col("toxic") == 1, "transcript:toxic"), (F.col("quality") == 0, "ocr:low quality"))
    status, reason = S.enrichment_status(F.col("ocr"), F.col("speech"), why, F.lit(True), F.col("speech"))
    return d.select("doc_id", status.alias("status"), reason.alias("reason"))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN '' WHEN value > 90 THEN 'rate_limited' WHEN value > 60 THEN 'timeout' WHEN value > 30 THEN 'server_error' ELSE 'http_error' END AS code,
       CASE WHEN event_type <> 'error' THEN 'none' WHEN value > 30 THEN 'transient' ELSE 'permanent' END AS class, CASE WHEN event_type <> 'error' THEN '' WHEN value > 90 THEN 'HTTP 429' WHEN value > 60 THEN 'request timed out' WHEN value > 30 THEN 'HTTP 503' ELSE 'not found' END AS kind FROM events""")
def t48_failure_classes(spark, sf) -> DataFrame:
    v = F.col("value")
    m = F.when(F.col("event_type") != "error", "").when(v > 90, "HTTP 429: slow down").when(v > 60, "request timed out: 30 s").when(v > 30, "HTTP 503: try later").otherwise("not found: gone")
    return table(spark, sf, "events").select("event_id", X.api_error_code(m).alias("code"), S.failure_class(m).alias("class"), X.error_type(m).alias("kind"))


@query(r"""
SELECT page_id, regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '(?i)<a\s'))::BIGINT AS links, strpos(lower(html), '<script') > 0 AS scripted FROM pages""")
def s14_page_extract(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit(r"(?i)<a\s")).cast("long").alias("links"), (F.instr(F.lower("html"), "<script") > 0).alias("scripted"))


@query(r"""
WITH l AS (SELECT conv_id, turn, list_filter(list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND NOT contains(x, '-->') AND NOT starts_with(x, 'WEBVTT') AND NOT starts_with(x, 'NOTE') AND NOT regexp_full_match(x, '[0-9]+')) AS own FROM conversations),
k AS (SELECT conv_id, turn, CASE WHEN own IS NOT NULL THEN list_concat(own, own, ['the end']) END AS said FROM l)
SELECT conv_id, turn, coalesce(array_to_string(list_filter(said, lambda x, i: i = 1 OR said[i - 1] <> x), ' '), '') AS plain, '["' || conv_id || '"]' AS unfenced FROM k""")
def s15_webvtt_and_fences(spark, sf) -> DataFrame:
    """Every turn as captions of two cues that both hold its text, and its conversation's id as a fenced response."""
    cue = lambda n, *said: F.concat(F.lit(f"{n}\n00:0{n}.000 --> 00:0{n + 1}.000\n"), *said, F.lit("\n\n"))
    vtt = F.concat(F.lit("WEBVTT\n\nNOTE x\n"), cue(1, F.col("text")), cue(2, F.col("text"), F.lit("\nthe end")))
    fenced = F.concat(F.lit('```json\n["'), F.col("conv_id").cast("string"), F.lit('"]\n```'))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.webvtt_text(vtt).alias("plain"), X.unfenced_json(fenced).alias("unfenced"))


#: Emoji by a document's number: families, keycaps, skin tones, flags of two kinds, plain ones, marks, none.
PLANTED = ("👨‍👩‍👧‍👦", "1️⃣", "👍🏽", "🇺🇸🇫🇷", "🏴󠁧󠁢󠁥󠁮󠁧󠁿", "🔥❤️🔥", "✔️ ©", "👩🏾‍🚀", "", "☀️🌍⭐", "🏳️‍🌈", "#⃣ 5", "🙋🏻‍♀️x🙋🏻‍♀️")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(f"""
WITH t AS (SELECT doc_id, {_sql_list(PLANTED)} AS p, coalesce(text, '') AS text FROM documents),
x AS (SELECT doc_id, p[(doc_id % 13 + 1)::INTEGER] || ' ' || text || ' ' || p[(doc_id // 13 % 13 + 1)::INTEGER] || p[(doc_id % 13 + 1)::INTEGER] AS s FROM t),
g AS (SELECT doc_id, list_filter(regexp_extract_all(s, '{'|'.join(E.SEQUENCES)}'), lambda y: NOT regexp_matches(y, '^[{''.join(map(chr, E.MARKS))}]{chr(0xFE0F)}?$')) AS g FROM x)
SELECT doc_id, len(g)::INTEGER AS glyphs, coalesce(array_to_string(list_transform(list_filter(list_zip(g, generate_series(1, len(g))), lambda z: list_position(g, z[1]) = z[2]), lambda z: z[1]), ' '), '') AS emoji FROM g""")
def t20_emoji_sequences(spark, sf) -> DataFrame:
    """Emoji of each whole text, joined families, keycaps, flags and skin tones as one each; every kind once, in order."""
    p, n = F.array(*map(F.lit, PLANTED)), F.col("doc_id")
    at = lambda i: F.get(p, (i % len(PLANTED)).cast("int"))
    text = F.concat(at(n), F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "), at(F.floor(n / len(PLANTED))), at(n))
    g = table(spark, sf, "documents").select("doc_id", E.sequences(text).alias("g"))
    return g.select("doc_id", F.size("g").alias("glyphs"), F.array_join(F.array_distinct("g"), " ").alias("emoji"))
