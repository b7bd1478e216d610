"""Functions of the engine for use in SQL: a scalar one, an aggregate and a table function."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import IntegerType, StringType, StructType

LINE = StructType().add("line", IntegerType()).add("words", IntegerType()).add("first", StringType())


@pandas_udf(StringType())
def leading(value: pd.Series, weight: pd.Series) -> str:
    """The two values of most weight, the heavier first, ties by name. An aggregate: give it one row a value and key."""
    w = weight.fillna(0).groupby(value.fillna("")).sum()
    return "|".join(sorted(w.index, key=lambda v: (-w[v], v))[:2])


@udtf(returnType=LINE, useArrow=True)
class Lines:
    """The lines of a text that hold a word: number from 1, number of words, first word."""

    def eval(self, text: str) -> Iterator[tuple[int, int, str]]:
        for n, line in enumerate((text or "").split("\n"), 1):
            words = [w for w in line.split(" ") if w]
            if words:
                yield n, len(words), words[0]


def register(spark: SparkSession) -> None:
    """vidsift_handle(text), vidsift_leading(value, weight) and vidsift_lines(text), for this session."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION vidsift_handle(s STRING) RETURNS STRING RETURN lower(regexp_replace(trim(s), '^@+', ''))")
    spark.udf.register("vidsift_leading", leading)
    spark.udtf.register("vidsift_lines", Lines)
