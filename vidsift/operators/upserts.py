"""Mutations as plans: what a table holds after a write, for stores without MERGE.

Each function takes the target's and the incoming rows and returns the target's new rows; io.swap() puts them in
place. All join on the key once, and applying one twice gives what applying it once gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import first_filled, row_one


def replace_by_key(target: DataFrame, rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Delete the incoming keys, insert the rows, one row per key (the first in ``order``)."""
    new = row_one(rows, [key], order)
    return target.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_missing(target: DataFrame, rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows of keys that the target lacks are added, the first in ``order`` each."""
    return target.unionByName(row_one(rows, [key], order).join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def fill_empty(target: DataFrame, rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """New keys are inserted; of existing rows only null or empty ``columns`` are filled. rows has one row per key."""
    t, r = target.withColumn("__t", F.lit(True)).alias("t"), rows.alias("r")
    joined = t.join(r, key, "full_outer")
    out = [F.col(key)]
    for c in target.columns:
        if c != key:
            old, new = F.col(f"t.{c}"), F.col(f"r.{c}") if c in rows.columns else F.lit(None)
            out.append((F.coalesce(first_filled(old, new), old) if c in columns else F.when(F.col("__t"), old).otherwise(new)).alias(c))
    return joined.select(*out)


def replace_children(target: DataFrame, rows: DataFrame, parent: str) -> DataFrame:
    """All children of the incoming parents go; the incoming ones come."""
    return target.join(rows.select(parent).distinct(), parent, "left_anti").unionByName(rows)


def sparse_update(target: DataFrame, rows: DataFrame, key: str, allowed: Sequence[str]) -> DataFrame:
    """Non-null incoming values of allowed columns overwrite; other columns stay. rows has one row per key."""
    joined = target.alias("t").join(rows.alias("r"), key, "full_outer")
    return joined.select(F.col(key), *[(F.coalesce(F.col(f"r.{c}"), F.col(f"t.{c}")) if c in allowed and c in rows.columns else F.col(f"t.{c}")).alias(c) for c in target.columns if c != key])


def update_where(target: DataFrame, when: Column, **values: Column) -> DataFrame:
    return target.withColumns({c: F.when(when, v).otherwise(F.col(c)) for c, v in values.items()})


def merge_with_provenance(target: DataFrame, rows: DataFrame, key: str, owned: Column, provenance: Sequence[str], base: Sequence[str], fill: Sequence[str], merged: str) -> DataFrame:
    """Upsert where an owner keeps its provenance.

    Base columns of an existing row are overwritten, ``fill`` columns only when empty, the ``merged`` list is united in
    first-seen order. Provenance columns are overwritten unless the existing row is ``owned`` (over columns t.*).
    rows has one row per key and the target's columns.
    """
    joined = target.withColumn("__t", F.lit(True)).alias("t").join(rows.withColumn("__r", F.lit(True)).alias("r"), key, "full_outer")
    has, comes = F.coalesce(F.col("__t"), F.lit(False)), F.coalesce(F.col("__r"), F.lit(False))
    empty = F.array().cast("array<string>")
    out = [F.col(key)]
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"r.{c}")
        if c == key:
            continue
        if c == merged:
            v = F.array_union(F.coalesce(old, empty), F.coalesce(new, empty))
        elif c in fill:
            v = F.when(has, first_filled(old, new)).otherwise(new)
        elif c in provenance:
            v = F.when(has & (owned | ~comes), old).otherwise(new)
        elif c in base:
            v = F.when(comes, new).otherwise(old)
        else:
            v = F.when(has, old).otherwise(new)
        out.append(v.alias(c))
    return joined.select(*out)
