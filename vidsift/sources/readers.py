"""Readers: lists, CSV with loose headers, landed JSON, keyed tables, newest files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as X
from ..operators.relational import numbered
from .schemas import RAW_RESPONSE, aligned


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(place, value): lines that are neither empty nor comments, lower case, without @; the first of equals kept."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), X.handle(F.col("value")).alias("value"))
    kept = lines.where("value <> '' and not startswith(value, '#')").groupBy("value").agg(F.min("at").alias("at"))
    return numbered(kept, ["at"], "place", 0).select("place", "value")


def keywords(spark: SparkSession, path: str, column: str = "term") -> DataFrame:
    """Keywords of a list, or of a CSV's ``column``, else its first."""
    if not path.endswith(".csv"):
        return listed(spark, path)
    df = spark.read.csv(path, header=True)
    c = column if column in df.columns else df.columns[0]
    v = df.select(F.monotonically_increasing_id().alias("at"), F.lower(X.strip(F.col(f"`{c}`"))).alias("value")).where("value <> ''")
    return numbered(v.groupBy("value").agg(F.min("at").alias("at")), ["at"], "place", 0).select("place", "value")


def header(name: str) -> str:
    return re.sub(r"\s+", " ", name.replace("﻿", "")).strip().lower()


def loose_csv(spark: SparkSession, path: str, wanted: dict[str, str]) -> DataFrame:
    """A CSV whose headers vary: each wanted column by its exact header, else by the first that starts so, else null."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    names = [header(c) for c in df.columns]
    df = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for column, needle in wanted.items():
        hit = next((i for i, n in enumerate(names) if n == needle), next((i for i, n in enumerate(names) if n.startswith(needle)), None))
        out.append((F.lit(None).cast("string") if hit is None else X.strip(F.col(f"c{hit}"))).alias(column))
    return df.select(*out)


def dated_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A dated export read again: header required, rows without any value dropped."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    df = df.toDF(*[header(c) for c in df.columns])
    some = F.lit(False)
    for c in df.columns:
        some = some | (F.coalesce(F.col(f"`{c}`"), F.lit("")) != "")
    return aligned(df.where(some), schema)


def raw_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines; a broken line is kept in _corrupt_record."""
    return spark.read.schema(StructType([*RAW_RESPONSE.fields, StructField("_corrupt_record", StringType())])).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def analysis_rows(spark: SparkSession, path: str, *priorities: str) -> DataFrame:
    """Rows of a JSON analysis file, of given priorities if any."""
    df = spark.read.option("multiLine", True).json(path)
    return df.where(F.col("priority").isin(*priorities)) if priorities else df


def by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def newest(spark: SparkSession, folder: str, glob: str) -> str | None:
    """The newest file of a folder that matches, by modification time, then name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "modificationTime")
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row.p


def hydration(df: DataFrame, html: str = "html", script_id: str = "__UNIVERSAL_DATA__", path: str = "$.item") -> DataFrame:
    """Adds ``item``: the JSON at ``path`` of the page's hydration script, null without one."""
    blob = F.regexp_extract(html, rf'(?s)<script[^>]*id="{re.escape(script_id)}"[^>]*>(.*?)</script>', 1)
    return df.withColumn("item", F.get_json_object(F.nullif(blob, F.lit("")), path))


def first_usable(spark: SparkSession, files: dict[str, str]) -> tuple[str | None, int]:
    """Of CSV exports in order of preference the first that has a row with any value: (its name, such rows)."""
    for name, path in files.items():
        df = spark.read.csv(path, header=True)
        some = F.lit(False)
        for c in df.columns:
            some = some | (F.coalesce(F.col(f"`{c}`"), F.lit("")) != "")
        if rows := df.where(some).count():
            return name, rows
    return None, 0
