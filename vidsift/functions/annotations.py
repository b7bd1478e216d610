"""Text annotations of four levels below a page, rebuilt in reading order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNOTATION = (
    "pages array<struct<blocks:array<struct<paragraphs:array<struct<words:array<struct<symbols:array<struct<text:string>>>>>>>>>>, text string"
)


def _filled(a: Column, text, sep: str) -> Column:
    """The texts of a list's elements that are not empty, joined."""
    kept = F.filter(F.transform(a, text), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.coalesce(F.array_join(kept, sep), F.lit(""))


def page_texts(annotation: Column) -> Column:
    """One text a page that has any: symbols make words, blanks join words, line ends paragraphs, empty lines blocks."""
    word = lambda w: _filled(w["symbols"], lambda s: s["text"], "")
    paragraph = lambda p: _filled(p["words"], word, " ")
    block = lambda b: _filled(b["paragraphs"], paragraph, "\n")
    return F.filter(F.transform(annotation["pages"], lambda p: _filled(p["blocks"], block, "\n\n")), lambda x: x != "")


def reading_order(annotation: Column) -> Column:
    """The pages' texts without white space around them; without any the annotation's own text, '' for neither."""
    return read_texts(page_texts(annotation), annotation["text"])


def read_texts(texts: Column, whole: Column) -> Column:
    """Pages' texts, made once by ``page_texts``, as one text."""
    rebuilt = F.nullif(F.array_join(texts, "\n\n"), F.lit(""))
    return F.btrim(F.coalesce(rebuilt, whole, F.lit("")), F.lit(" \t\n\x0b\f\r"))
