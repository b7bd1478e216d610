"""URL filters by hashed expressions.

A url is expanded into expressions (a suffix of its host's labels and a prefix of its path), each expression is
hashed, and hashes meet the rules on a short prefix; full digests confirm, and the longest rule decides. Only suffixes
of as many labels and prefixes of as many characters as some rule has are made, so long urls stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEFAULT = "allow"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path joined, null if none fits), verdict.

    rules has (verdict, host, path). A rule fits its host and all subdomains where the path starts with the rule's;
    the longest wins, then the longer host, then block. Null urls, and urls that no rule fits, get ``default``;
    repeated and null page ids each get a row; an empty table gives none. Null rules, and rules without host, fit
    nothing. Other columns are ignored.
    """
    r = rules.select(F.col("verdict").alias("r_verdict"), F.col("host").alias("r_host"), F.col("path").alias("r_path")).where("r_verdict is not null and r_host <> '' and r_path is not null")
    shape = r.agg(F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths")).first()
    digest = F.sha2(F.concat("r_host", "r_path"), 256)
    place = F.struct(F.length(F.concat("r_host", "r_path")).alias("all"), F.length("r_host").alias("host"), (F.col("r_verdict") == "block").alias("block"))
    r = r.select(F.substring(digest, 1, PREFIX_DIGITS).alias("short"), digest.alias("r_digest"), F.struct(place.alias("place"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")).alias("r"))
    host, path = parts(F.col(url))
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("uid"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, shape.labels or 1)))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    lengths = F.filter(F.lit(list(shape.lengths)) if shape.lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(lengths, lambda n: F.concat(s, F.substr(F.col("path"), F.lit(1), n)))))
    seen = p.select("uid", "page_id", "host", "path", F.explode_outer(expressions).alias("e")).withColumn("digest", F.sha2("e", 256)).drop("e")
    met = seen.join(r, (F.substring("digest", 1, PREFIX_DIGITS) == F.col("short")), "left")
    best = F.max(F.when(F.col("digest") == F.col("r_digest"), F.col("r"))).alias("r")
    out = met.groupBy("uid").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), best)
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.lit(default)).alias("verdict"))
