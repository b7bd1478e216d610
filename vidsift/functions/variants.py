"""JSON of any shape as VARIANT: hydration records walked by path, and search at any depth."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

SCRIPT_ID = "__UNIVERSAL_DATA_FOR_REHYDRATION__"
ITEM = '$["__DEFAULT_SCOPE__"]["webapp.video-detail"].itemInfo.itemStruct'


def script_blob(html: Column, script_id: str = SCRIPT_ID) -> Column:
    """The JSON of a page's script as VARIANT; null without the script, and for broken JSON."""
    found = F.regexp_extract(html, rf'(?s)<script[^>]*id="{re.escape(script_id)}"[^>]*>(.*?)</script>', 1)
    return F.try_parse_json(F.nullif(found, F.lit("")))


def item_of(blob: Column, path: str = ITEM) -> Column:
    return F.try_variant_get(blob, path, "variant")


def text_at(v: Column, *paths: str) -> Column:
    """The first text at any of the paths that is neither missing nor empty, else null."""
    return F.coalesce(*[F.nullif(F.try_variant_get(v, p, "string"), F.lit("")) for p in paths])


def _list_at(v: Column, path: str, kind: str = "array<variant>") -> Column:
    return F.coalesce(F.try_variant_get(v, path, kind), F.array().cast(kind))


def sticker_texts(item: Column) -> Column:
    """Lines of all stickers in order, without blanks around them and without empty ones."""
    lines = F.flatten(F.transform(_list_at(item, "$.stickersOnItem"), lambda s: _list_at(s, "$.stickerText", "array<string>")))
    return F.filter(F.transform(lines, lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"^\s+|\s+$", "")), lambda x: x != "")


def caption_tracks(item: Column) -> Column:
    """(language, format, url) of the caption list, then those of the subtitle list whose url is new."""
    track = lambda language, format_, url: F.struct(F.coalesce(language, F.lit("")).alias("language"), F.coalesce(format_, F.lit("")).alias("format"), url.alias("url"))
    with_url = lambda a: F.filter(a, lambda t: t["url"].isNotNull())
    captions = with_url(F.transform(_list_at(item, "$.video.claInfo.captionInfos"), lambda c: track(text_at(c, "$.language", "$.Language"), text_at(c, "$.captionFormat", "$.format"), text_at(c, "$.url", "$.Url"))))
    subtitles = with_url(F.transform(_list_at(item, "$.video.subtitleInfos"), lambda c: track(text_at(c, "$.LanguageCodeName"), F.lit("subtitleInfos"), text_at(c, "$.Url", "$.url"))))
    seen_before = lambda t, i: F.exists(captions, lambda c: c["url"] == t["url"]) | F.exists(F.slice(subtitles, F.lit(1), i), lambda c: c["url"] == t["url"])
    return F.concat(captions, F.filter(subtitles, lambda t, i: ~seen_before(t, i)))


def record(item: Column, url: Column, site: str) -> list[Column]:
    """The columns of one video's record; a page without item has an error and its url only."""
    stickers, user, video = sticker_texts(item), text_at(item, "$.author.uniqueId"), text_at(item, "$.id")
    text = lambda c: F.when(item.isNotNull(), F.coalesce(c, F.lit("")))
    address = F.when(user.isNotNull() & video.isNotNull(), F.concat(F.lit(f"{site}/@"), user, F.lit("/video/"), video)).otherwise(url)
    tracks = F.transform(caption_tracks(item), lambda t: F.concat_ws("|", t["language"], t["format"], t["url"]))
    return [
        F.when(item.isNull(), "hydration_item_struct_missing").alias("error"),
        text(video).alias("video_id"),
        text(user).alias("username"),
        text(text_at(item, "$.author.nickname")).alias("display_name"),
        text(text_at(item, "$.desc")).alias("caption"),
        text(F.array_join(stickers, "\n---\n")).alias("onscreen_text"),
        text(F.array_join(tracks, "\n")).alias("tracks"),
        F.when(item.isNotNull(), F.size(stickers) > 0).alias("has_stickers"),
        F.when(item.isNotNull(), address).alias("canonical_url"),
    ]


def search(df: DataFrame, key: str, raw: str, words: Sequence[str]) -> DataFrame:
    """(key, path, match): where a JSON text of any depth has one of the words in a key, or in the text of three letters or more
    that a key holds; texts inside lists do not count.

    Each round opens all objects and lists of one level at once, so there are as many rounds as the deepest text has
    levels, and a text that ends early costs later rounds nothing. Case does not matter; broken JSON and null give no row.
    """
    spark = df.sparkSession
    wanted = "|".join(re.escape(w.lower()) for w in words)
    level = df.select(F.col(key).alias("key"), F.lit("").alias("path"), F.try_parse_json(raw).alias("v")).where("v is not null")
    found = None
    while True:
        inner = spark.sql("SELECT f.key, f.path, x.pos, x.key AS name, x.value AS v FROM {f} f, LATERAL variant_explode(f.v) x", f=level)
        here = F.when(F.col("name").isNull(), F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("name")).otherwise(F.concat_ws(".", "path", "name"))
        kind = F.schema_of_variant("v")
        inner = cut(inner.select("key", here.alias("path"), "name", "v", kind.alias("kind")))
        if inner.isEmpty():
            break
        text = F.when(F.col("kind") == "STRING", F.try_variant_get("v", "$", "string"))
        hit = F.array_compact(F.array(F.when(F.lower("name").rlike(wanted), "key"), F.when(F.col("name").isNotNull() & (F.length(text) > 2) & F.lower(text).rlike(wanted), "value")))
        hits = inner.select("key", "path", F.explode(hit).alias("match"))
        found = hits if found is None else found.unionByName(hits)
        level = inner.where("kind like 'OBJECT%' or kind like 'ARRAY%'").select("key", "path", "v")
    if found is None:
        found = level.select("key", "path", F.lit("").alias("match")).limit(0)
    return found.select(F.col("key").alias(key), "path", "match")
