"""Emoji glyphs, their kinds and categories, as expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges of glyphs: flags, pictographs with modifiers, miscellaneous symbols and dingbats.
GLYPHS = r"[\x{1F1E0}-\x{1F1FF}]{2}|[\x{1F300}-\x{1FAFF}][\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}]*|[\x{2600}-\x{27BF}]\x{FE0F}?"
#: Code points of interface marks; a glyph that holds one is dropped.
MARKS = (0x00A9, 0x00AE, 0x00B0, 0x2022, 0x2122, 0x25A0, 0x25A1, 0x25CB, 0x25CF, 0x2610, 0x2611, 0x2713, 0x2714, 0x26AA, 0x26AB)
#: The joiner and the variation selector, which drop a glyph too if the rule is strict.
JOINERS = (0x200D, 0xFE0F)
#: Names that differ from those of the Unicode database.
NAMES = {"🧊": "ice cube", "🔫": "water pistol", "🍉": "watermelon", "🔥": "fire", "❤": "red heart", "😂": "face with tears of joy", "😭": "loudly crying face", "🚨": "police car light", "🇺🇸": "flag United States"}
#: Words of a glyph's name and its category; the first rule with a word in the name holds.
CATEGORIES = (
    (("ice cube",), "object"),
    (("watermelon", "food", "fruit", "pizza", "coffee", "beer", "drink"), "food"),
    (("face", "smile", "cry", "angry", "kiss", "heart-eyes", "tears"), "emotion"),
    (("heart",), "emotion"),
    (("fire", "sparkles", "collision", "boom", "100"), "emphasis"),
    (("hand", "thumb", "clap", "wave", "point", "fist", "pray", "shrug"), "gesture"),
    (("person", "man", "woman", "baby", "family"), "people"),
    (("animal", "dog", "cat", "bird", "fish", "duck"), "animal"),
    (("pistol", "gun", "knife", "bomb"), "object"),
    (("police", "car", "light", "ambulance"), "object"),
    (("music", "microphone", "note", "camera", "movie"), "media"),
)
#: Ranges of code points with a kind of their own.
SYMBOLS = r"\x{2600}-\x{2664}\x{2666}-\x{26FF}"
CHECKS = r"\x{25CB}\x{25CF}\x{2611}\x{2713}\x{2714}\x{26AA}\x{26AB}"
PICTURES = r"\x{1F300}-\x{1FAFF}"
REGIONAL = r"\x{1F1E6}-\x{1F1FF}"
SKIN = r"\x{1F3FB}-\x{1F3FF}"


#: One glyph of a sequence: a picture or symbol with its selector or skin tone.
_ONE = r"(?:[\x{1F300}-\x{1F3FA}\x{1F400}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}](?:\x{FE0F}|[\x{1F3FB}-\x{1F3FF}])?)"
#: Longest first: keycaps, regional flags, flags spelled in tags, glyphs held together by joiners, a lone skin tone.
SEQUENCES = (
    r"[0-9#*]\x{FE0F}?\x{20E3}",
    r"[\x{1F1E6}-\x{1F1FF}]{2}",
    r"\x{1F3F4}[\x{E0020}-\x{E007E}]+\x{E007F}",
    rf"{_ONE}(?:\x{{200D}}(?:{_ONE}|[\x{{2640}}\x{{2642}}\x{{2695}}\x{{2696}}\x{{2708}}]\x{{FE0F}}?))*",
    r"[\x{1F3FB}-\x{1F3FF}]",
)


def sequences(c: Column) -> Column:
    """Emoji of a text in order, each whole: families of joined glyphs, keycaps, flags and skin tones are one.

    Interface marks that stand alone are no emoji; inside a joined sequence they count with it.
    """
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("|".join(SEQUENCES)), F.lit(0))
    return F.filter(found, lambda g: ~g.rlike(f"^{_class(MARKS)}\\x{{FE0F}}?$"))


def _class(points) -> str:
    return "[" + "".join(f"\\x{{{p:X}}}" for p in points) + "]"


def glyphs(c: Column, strict: bool = True) -> Column:
    """Glyphs of a text in order; with ``strict`` those that hold a variation selector or joiner go."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(GLYPHS), F.lit(0))
    dropped = _class(MARKS + JOINERS if strict else MARKS)
    return F.filter(found, lambda g: ~g.rlike(dropped))


#: Kinds by the form of a whole glyph; what has none of these forms is an emoji.
FORMS = {
    "flag": f"(?:[^{REGIONAL}]*[{REGIONAL}]){{2}}",
    "modifier": f"^[{SKIN}]$",
    "symbol": f"[{CHECKS}]|^[^{PICTURES}\\x{{2665}}\\x{{2764}}]*[{SYMBOLS}][^{PICTURES}\\x{{2665}}\\x{{2764}}]*$",
}


def kind(g: Column) -> Column:
    return F.coalesce(*[F.when(g.rlike(form), name) for name, form in FORMS.items()], F.lit("emoji"))


def codepoints(g: Column) -> Column:
    return F.array_join(F.transform(F.filter(F.split(g, ""), lambda x: x != ""), lambda x: F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(x)), F.greatest(F.lit(4), F.length(F.hex(F.ascii(x)))), F.lit("0")))), " ")


def category(kind_: Column, name: Column) -> Column:
    n = F.lower(name)
    by_kind = F.when((kind_ == "flag") | n.contains("flag"), "flag").when(kind_.isin("modifier", "symbol"), kind_)
    return F.coalesce(by_kind, *[F.when(n.rlike("|".join(map(re.escape, words))), label) for words, label in CATEGORIES], F.lit("object"))


def name_table(spark: SparkSession) -> DataFrame:
    """(emoji, emoji_name): one row per single-character glyph, built from the Unicode database."""
    rows = {chr(p): unicodedata.name(chr(p), "").lower() for a, b in ((0x1F300, 0x1FAFF), (0x2600, 0x27BF)) for p in range(a, b + 1)}
    return spark.createDataFrame([(g, NAMES.get(g, n)) for g, n in (rows | {k: v for k, v in NAMES.items() if k not in rows}).items() if n or g in NAMES], "emoji string, emoji_name string")


def emoji_rows(df: DataFrame, key: str, layers: dict[str, Column]) -> DataFrame:
    """One row per (key, text_source, emoji): count, kind, name, category, codepoint; symbols are dropped."""
    made = df.select(key, F.explode(F.array(*[F.struct(F.lit(n).alias("text_source"), glyphs(c).alias("g")) for n, c in layers.items()])).alias("x"))
    each = made.select(key, "x.text_source", F.explode("x.g").alias("emoji")).groupBy(key, "text_source", "emoji").agg(F.count("*").alias("count"))
    k = kind(F.col("emoji"))
    named = each.withColumn("emoji_kind", k).where("emoji_kind <> 'symbol'").join(F.broadcast(name_table(df.sparkSession)), "emoji", "left")  # a fixed table of under 3,000 rows
    name = F.coalesce("emoji_name", codepoints(F.col("emoji")))
    return named.select(key, "text_source", "emoji", "count", "emoji_kind", name.alias("emoji_name"), category(F.col("emoji_kind"), name).alias("emoji_category"), codepoints(F.col("emoji")).alias("emoji_codepoint"))


def rollup(rows: DataFrame, key: str) -> DataFrame:
    """Glyphs of each key by falling count, then glyph, joined by bars."""
    per = rows.groupBy(key, "emoji").agg(F.sum("count").alias("n"), F.max("emoji_name").alias("name"), F.max("emoji_category").alias("category"), F.array_sort(F.collect_set("text_source")).alias("sources"))
    listed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "emoji", "name", "category", "sources")))
    joined = lambda a: F.array_join(a, " | ")
    return per.groupBy(key).agg(listed.alias("l")).select(key, joined(F.col("l.emoji")).alias("emoji_characters"), joined(F.col("l.name")).alias("emoji_descriptions"), joined(F.array_distinct("l.category")).alias("emoji_category"), joined(F.array_distinct(F.flatten("l.sources"))).alias("emoji_source"), (-F.aggregate("l.m", F.lit(0).cast("long"), lambda a, x: a + x)).alias("emoji_count"))


def context_words(df: DataFrame, key: str, text: Column, glyph: str, chars: int = 80, words: int = 4, most: int = 20) -> DataFrame:
    """(key, words): the words next to each occurrence of a glyph, each once, ``most`` at most (the cap is the feature)."""
    pieces = df.select(key, F.split(text, re.escape(glyph)).alias("p")).where(F.size("p") > 1)
    near = lambda x: F.filter(F.split(x, r"\s+"), lambda w: w != "")
    hits = F.sequence(F.lit(1), F.size("p") - 1)
    # the pieces that can lie within so many characters: each has a glyph between it and the next
    before = F.transform(hits, lambda i: F.reverse(F.slice(F.reverse(near(F.right(F.array_join(F.slice("p", F.greatest(F.lit(1), i - chars), F.least(i, F.lit(chars + 1))), glyph), F.lit(chars)))), 1, words)))
    after = F.transform(hits, lambda i: F.slice(near(F.left(F.array_join(F.slice("p", i + 1, F.lit(chars + 1)), glyph), F.lit(chars))), 1, words))
    found = F.array_distinct(F.flatten(F.concat(before, after)))
    return pieces.select(key, F.slice(found, 1, most).alias("words")).where(F.size("words") > 0)
