"""Queries over JSON of any shape: hydration records of pages, search in nested payloads, nested text annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import annotations as A
from ..functions import variants as V
from ..registry import query
from ..session import table

SITE = "https://video.example"


def _hydrated(spark, sf) -> DataFrame:
    """Pages whose html ends in a hydration script: one in nine has none, one broken JSON, one no item."""
    n = F.col("page_id")
    url = lambda name, tail: F.concat(F.lit(f"https://cdn.example/{name}/"), n.cast("string"), F.lit(tail))
    caption = F.struct(F.lit("en").alias("language"), F.lit("webvtt").alias("captionFormat"), url("cap", ".vtt").alias("url"))
    upper = F.struct(F.lit("fr").alias("Language"), F.lit("").alias("url"), url("cap", "-fr.vtt").alias("Url"))
    subtitle = lambda c: F.struct(F.lit("eng-US").alias("LanguageCodeName"), c.alias("Url"))
    item = F.struct(
        n.cast("string").alias("id"),
        F.col("url").alias("desc"),
        F.struct(F.when(n % 7 != 0, F.concat(F.lit("user_"), (n % 7).cast("string"))).alias("uniqueId"), F.concat(F.lit("User "), (n % 7).cast("string")).alias("nickname")).alias("author"),
        F.when(n % 2 == 0, F.array(F.struct(F.array(F.concat(F.lit(" first "), n.cast("string")), F.lit("  "), F.lit("second")).alias("stickerText")))).alias("stickersOnItem"),
        F.struct(
            F.struct(F.to_json(F.array(caption)).alias("a"), F.to_json(F.array(upper)).alias("b")).alias("raw"),
            F.array(subtitle(url("cap", ".vtt")), subtitle(url("sub", ".srt")), subtitle(url("sub", ".srt"))).alias("subtitleInfos"),
        ).alias("video"),
    )
    # a caption list of two shapes, which one struct type cannot hold
    whole = F.regexp_replace(F.to_json(item), r'"raw":\{"a":"\[(.*?)\]","b":"\[(.*?)\]"\}', '"claInfo":{"captionInfos":[$1,$2]}')
    whole = F.when(n % 4 == 0, F.replace(whole, F.lit("\\"), F.lit(""))).otherwise(F.regexp_replace(whole, r'"claInfo":\{.*?\]\},', ""))
    inner = F.when(n % 9 == 2, F.lit("{}")).otherwise(F.concat(F.lit('{"webapp.video-detail":{"itemInfo":{"itemStruct":'), whole, F.lit("}}}")))
    blob = F.concat(F.lit('{"__DEFAULT_SCOPE__":'), inner, F.when(n % 9 == 1, "").otherwise("}"))
    script = F.when(n % 9 == 0, "").otherwise(F.concat(F.lit(f'<script id="{V.SCRIPT_ID}" type="application/json">'), blob, F.lit("</script>")))
    return table(spark, sf, "pages").select("page_id", "url", F.concat(F.coalesce("html", F.lit("")), script).alias("html"))


HYDRATED_SQL = r"""
WITH p AS (SELECT page_id AS n, url, page_id % 9 > 2 AS has FROM pages)
"""


@query(HYDRATED_SQL + r"""SELECT n AS page_id, has AS found, CASE WHEN has THEN n::VARCHAR END AS item_id, CASE WHEN has THEN url END AS caption FROM p""")
def s14_hydration_item(spark, sf) -> DataFrame:
    """The item in a page's hydration script, found by path; missing scripts, broken JSON and missing items are null."""
    item = V.item_of(V.script_blob(F.col("html")))
    found = _hydrated(spark, sf).select("page_id", item.alias("item"))
    return found.select("page_id", F.col("item").isNotNull().alias("found"), V.text_at(F.col("item"), "$.id").alias("item_id"), V.text_at(F.col("item"), "$.desc").alias("caption"))


@query(HYDRATED_SQL + r"""
SELECT n AS page_id, CASE WHEN NOT has THEN 'hydration_item_struct_missing' END AS error, CASE WHEN has THEN n::VARCHAR END AS video_id,
       CASE WHEN has THEN CASE WHEN n % 7 = 0 THEN '' ELSE 'user_' || n % 7 END END AS username, CASE WHEN has THEN 'User ' || n % 7 END AS display_name, CASE WHEN has THEN url END AS caption,
       CASE WHEN has THEN CASE WHEN n % 2 = 0 THEN 'first ' || n || chr(10) || '---' || chr(10) || 'second' ELSE '' END END AS onscreen_text,
       CASE WHEN has THEN CASE WHEN n % 4 = 0 THEN 'en|webvtt|https://cdn.example/cap/' || n || '.vtt' || chr(10) || 'fr||https://cdn.example/cap/' || n || '-fr.vtt' ELSE 'eng-US|subtitleInfos|https://cdn.example/cap/' || n || '.vtt' END
            || chr(10) || 'eng-US|subtitleInfos|https://cdn.example/sub/' || n || '.srt' END AS tracks,
       CASE WHEN has THEN n % 2 = 0 END AS has_stickers,
       CASE WHEN has THEN CASE WHEN n % 7 = 0 THEN url ELSE 'https://video.example/@user_' || n % 7 || '/video/' || n END END AS canonical_url FROM p""")
def s23_hydration_record(spark, sf) -> DataFrame:
    """Stickers, caption and subtitle tracks, and the author of each page's video in one record."""
    found = _hydrated(spark, sf).select("page_id", "url", V.item_of(V.script_blob(F.col("html"))).alias("item"))
    return found.select("page_id", *V.record(F.col("item"), F.col("url"), SITE))


@query(r"""
WITH c AS (SELECT DISTINCT click_id, props FROM clicks WHERE json_valid(props)),
j AS (SELECT c.click_id, t.fullkey, t.key, t.type, json_extract_string(t.value, '$') AS value FROM c, json_tree(props) t)
SELECT click_id, substr(fullkey, 3) AS path, 'key' AS match FROM j WHERE NOT ends_with(fullkey, ']') AND regexp_matches(lower(key), 'sku|os|ver')
UNION ALL
SELECT click_id, substr(fullkey, 3), 'value' FROM j WHERE NOT ends_with(fullkey, ']') AND type = 'VARCHAR' AND length(value) > 2 AND regexp_matches(lower(value), 'sku|os|ver')""")
def t51_json_tree_search(spark, sf) -> DataFrame:
    """Where the payload of each click holds one of three words in a key or a text, at any depth."""
    c = table(spark, sf, "clicks").select("click_id", "props").distinct()
    return V.search(c, "click_id", "props", ["sku", "OS", "ver"])


@query(r"""
WITH w AS (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), p -> array_to_string(list_filter(list_transform(string_split(p, '. '), b -> array_to_string(list_filter(list_transform(string_split(b, ', '),
         q -> array_to_string(list_filter(string_split(q, ' '), lambda x: x <> ''), ' ')), lambda x: x <> ''), chr(10))), lambda x: x <> ''), chr(10) || chr(10))), lambda x: x <> '') AS pages, text FROM documents)
SELECT doc_id, regexp_replace(coalesce(nullif(array_to_string(pages, chr(10) || chr(10)), ''), text, ''), '^\s+|\s+$', '', 'g') AS read, len(pages)::INTEGER AS pages FROM w""".replace("p ->", "lambda p:").replace("b ->", "lambda b:").replace("q ->", "lambda q:"))
def t58_nested_reading_order(spark, sf) -> DataFrame:
    """Texts rebuilt from annotations of four levels: symbols to words, words to paragraphs, those to blocks and pages."""
    half = lambda w: F.array(F.left(w, F.floor(F.length(w) / 2).cast("int")), F.substr(w, F.floor(F.length(w) / 2).cast("int") + 1))
    symbols = lambda w: F.struct(F.transform(half(w), lambda s: F.struct(s.alias("text"))).alias("symbols"))
    level = lambda c, sep, name, inner: F.transform(F.split(c, sep), lambda x: F.struct(inner(x).alias(name)))
    pages = level(F.col("text"), "\n", "blocks", lambda p: level(p, r"\. ", "paragraphs", lambda b: level(b, ", ", "words", lambda q: F.transform(F.split(q, " "), symbols))))
    raw = table(spark, sf, "documents").select("doc_id", F.to_json(F.struct(pages.alias("pages"), F.col("text"))).alias("raw"))
    read = raw.select("doc_id", F.from_json("raw", A.ANNOTATION).alias("a"))
    texts = read.select("doc_id", A.page_texts(F.col("a")).alias("texts"), F.col("a.text").alias("whole"))
    return texts.select("doc_id", A.read_texts(F.col("texts"), F.col("whole")).alias("read"), F.coalesce(F.size("texts"), F.lit(0)).alias("pages"))
