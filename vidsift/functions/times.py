"""Research days, windows and chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def research_date(c: Column) -> Column:
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyyMMdd"))


def civil_window(day: Column, zone: str) -> tuple[Column, Column]:
    """Half-open UTC window of a civil day; 23, 24 or 25 hours."""
    at = lambda d: F.to_utc_timestamp(d.cast("timestamp"), zone)
    return at(day), at(F.date_add(day, 1))


def instant(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def api_dates(start: Column, end: Column) -> tuple[Column, Column]:
    """First and last UTC day that a half-open window touches."""
    return F.date_format(start, "yyyyMMdd"), F.date_format(end - F.expr("INTERVAL 1 MICROSECOND"), "yyyyMMdd")


def chunks(start: Column, end: Column, days: int = 30) -> Column:
    """Array of (start, end) dates of at most ``days``, sharing endpoints; none when start = end."""
    starts = F.when(start < end, F.filter(F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS")), lambda s: s < end)).otherwise(F.array().cast("array<date>"))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, days), end).alias("end")))


def lagged(now: Column, days: int, zone: str) -> Column:
    return F.date_sub(F.to_date(F.from_utc_timestamp(now, zone)), days)


def epoch_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss UTC`` in a UTC session, empty for none."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit(""))
