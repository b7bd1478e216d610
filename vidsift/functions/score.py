"""Scores and status ladders of a video row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def points(when: Column, n: int) -> Column:
    return F.when(when, n).otherwise(0)


def enrichment_quality(metadata: Column, speech: Column, ocr: Column, voice: Column, emoji: Column, sticker: Column) -> Column:
    """0 to 100; a row without metadata scores 0."""
    total = 20 + points(speech, 30) + points(ocr, 30) + points(voice, 10) + points(emoji, 5) + points(sticker, 5)
    return F.when(metadata, F.least(total, F.lit(100))).otherwise(0)


def reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """Array of the texts whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(v) if isinstance(v, str) else v) for c, v in pairs]))


def enrichment_status(ocr: Column, speech: Column, why: Column, text_layer: Column, spoken: Column) -> tuple[Column, Column]:
    """(status, reasons joined by " | ").

    why is the array of failure reasons. Both layers and no reason is ok, a layer is partial, reasons alone are
    failed, nothing is partial. A partial row without a reason that has speech or voice text is ok; an ok row
    without any text layer is partial for missing:text_layers.
    """
    none = F.size(why) == 0
    first = F.when(ocr & speech, F.when(none, "ok").otherwise("partial")).when(ocr | speech, "partial").when(~none, "failed").otherwise("partial")
    lifted = F.when((first == "partial") & none & spoken, "ok").otherwise(first)
    bare = (lifted == "ok") & ~text_layer
    joined = F.array_join(why, " | ")
    return F.when(bare, "partial").otherwise(lifted), F.when(bare, F.concat_ws(" | ", F.nullif(joined, F.lit("")), F.lit("missing:text_layers"))).otherwise(joined)


def ocr_status(text: Column, frames: Column) -> Column:
    return F.when(F.coalesce(F.length(F.trim(text)), F.lit(0)) > 0, "ok").when(F.coalesce(frames, F.lit(0)) > 0, "failed").otherwise("missing")


def failure_class(message: Column) -> Column:
    """Transient failures are worth another try."""
    transient = r"(?i)timeout|timed out|temporar|rate.?limit|\b429\b|\b5\d\d\b|connection|reset|unavailable"
    return F.when(F.coalesce(message, F.lit("")) == "", "none").when(message.rlike(transient), "transient").otherwise("permanent")
