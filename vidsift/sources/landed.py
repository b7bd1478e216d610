"""Landed API pages: one JSON line a page, read with a declared schema and flattened."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

PAGE = "search_id string, cursor long, has_more boolean, items array<struct<id:string,username:string,keywords:array<string>,text:string,at:long>>"


def workspace(spark: SparkSession, name: str) -> str:
    """A new path for a table that a query writes and reads again, in the folder that all nodes share."""
    return f"{shared_folder(spark)}/vidsift_io/{uuid4().hex}/{name}"


def land(df: DataFrame, path: str, search: Column, per_page: int = 100) -> None:
    """Write items (id, username, keywords, text, at) as pages of at most ``per_page``, numbered within a search."""
    item = F.struct(*[F.col(c) for c in ("id", "username", "keywords", "text", "at")])
    paged = df.select(search.alias("search_id"), F.floor(F.col("at") / per_page).alias("page"), item.alias("item"))
    pages = paged.groupBy("search_id", "page").agg(F.sort_array(F.collect_list("item")).alias("items"))
    pages.select("search_id", (F.col("page") * per_page).alias("cursor"), F.lit(True).alias("has_more"), "items").write.json(path)


def items(spark: SparkSession, path: str) -> DataFrame:
    """Items of all landed pages, each once even if two pages hold it."""
    each = spark.read.schema(PAGE).json(path).select("search_id", F.explode("items").alias("x")).select("search_id", "x.*")
    return each.dropDuplicates(["search_id", "id"])


def checkpoint_sets(spark: SparkSession, path: str) -> DataFrame:
    """(kind, key): the sets of a JSON state file, {"completed": [...], "failed": [...], "partial": [...]}."""
    state = spark.read.schema("completed array<string>, failed array<string>, partial array<string>").option("multiLine", True).json(path)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(k), F.array().cast("array<string>")).alias("keys")) for k in ("completed", "failed", "partial")]))
    return state.select(each.alias("x")).select("x.kind", F.explode("x.keys").alias("key")).distinct()
