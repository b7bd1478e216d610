"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Sources share a budget of words by weight, none above a multiple of its size. A source gives whole epochs first and
then a weighted sample without replacement: documents in ascending order of -ln(u) / quality weight, u a hash of the
id, as long as a document's middle word lies within the remaining budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, running_sum

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2
SEED = 17


def size_of(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Squared share of characters that are no ASCII marks or digits, 0.05 at least; 0.05 for null and empty."""
    rest = F.length(F.regexp_replace(text, r"[!-@\[-`{-~]+", ""))
    share = F.try_divide(rest.cast("double"), F.length(text).cast("double"))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(0.05))


def sample_key(doc_id: Column, weight: Column, seed: int = SEED) -> Column:
    """The exponential key of a document; the id decides, so reruns agree."""
    digest = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 13)
    u = (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(u) / weight


def targets(scratch: Scratch, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Weights go round by the sources' code-point order, null last. Each round fixes the sources whose share passes
    their ceiling and shares the rest anew; only sums come to the driver.
    """
    by_source = scratch.save(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running_sum(scratch, by_source.withColumn("one", F.lit(1)), [F.col("source").isNull().asc(), F.col("source").asc()], "one", "rank", name="ranks")
    w = F.lit(weights[-1])
    for i, x in enumerate(weights[:-1]):
        w = F.when(F.col("rank") % len(weights) == i, x).otherwise(w)
    s = scratch.save(ranked.select("source", "source_size", w.cast("long").alias("w"), (F.col("source_size") * ceiling).alias("cap")), "weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = 0.0, F.lit(False)
    for _ in range(10_000):
        r = s.agg(F.sum(F.when(capped, F.col("cap"))).alias("c"), F.sum(F.when(~capped, F.col("w"))).alias("w"), F.count_if(capped).alias("n")).first()
        if not r.w:
            break
        rate = (share * total - (r.c or 0)) / r.w
        above = F.col("w") * F.lit(rate) > F.col("cap")
        if s.where(above).count() == r.n:
            break
        capped = above
    goal = F.when(F.col("w") * F.lit(rate) > F.col("cap"), F.col("cap").cast("double")).otherwise(F.col("w") * F.lit(rate))
    return scratch.save(s.select("source", "source_size", goal.alias("target")), "targets")


def _sized(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    t = F.col(text)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(t).alias("size"), sample_key(F.col(doc_id), quality_weight(t)).alias("key"))


def _epochs() -> tuple[Column, Column]:
    full = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)).cast("long")
    return full, F.col("target") - full * F.col("source_size")


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, epochs counted).

    Null sources are one source, last; null and empty texts have size 0 and are taken 0 words; rows that repeat an id
    share its key and count one by one; an empty table gives none. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    sized = scratch.save(_sized(docs, doc_id, source, text), "sizes")
    goals = targets(scratch, sized.select("source", "size"))
    before = running_sum(scratch, sized, [F.col("key").asc(), F.col("size").asc(), F.col("doc_id").asc()], "size", "before", group="source")
    goals = goals.withColumnRenamed("source", "__source")
    full, rest = _epochs()
    once = F.when(F.col("before") + F.col("size") / 2 <= rest, 1).otherwise(0)
    joined = before.join(goals, F.col("source").eqNullSafe(F.col("__source")))
    return joined.select("doc_id", "size", "source_size", "target", ((full + once) * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of docs, with their columns, each as often as the mix takes it.

    As in mix(), but the sample of a source ends at a cut of (key, size, id), so only the sources' cuts meet the
    documents: rows that repeat an id with one text are taken together. Columns of docs may have any names.
    """
    scratch = Scratch(docs.sparkSession)
    sized = scratch.save(_sized(docs, doc_id, source, text), "sizes")
    goals = targets(scratch, sized.select("source", "size"))
    before = running_sum(scratch, sized, [F.col("key").asc(), F.col("size").asc(), F.col("doc_id").asc()], "size", "before", group="source")
    full, rest = _epochs()
    own_, again, source_, full_, cut_, cs = fresh(docs.columns, "__own", "__again", "__source", "__full", "__cut", "__cs")
    g = goals.withColumnRenamed("source", source_)
    place = F.struct(F.col("key"), F.col("size"), F.col("doc_id").isNotNull().alias("has"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"))
    inside = before.join(g, F.col("source").eqNullSafe(F.col(source_))).where(F.col("before") + F.col("size") / 2 <= rest)
    cuts = inside.groupBy("source").agg(F.max(place).alias(cut_)).withColumnRenamed("source", cs)
    plan = g.withColumn(full_, full).join(cuts, F.col(source_).eqNullSafe(F.col(cs)), "left").select(source_, full_, cut_)
    t = F.col(f"`{text}`")
    own = F.struct(sample_key(F.col(f"`{doc_id}`"), quality_weight(t)).alias("key"), size_of(t).alias("size"), F.col(f"`{doc_id}`").isNotNull().alias("has"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(0)).alias("id"))
    times = (F.col(full_) + F.when(F.col(own_) <= F.col(cut_), 1).otherwise(0)).cast("int")
    met = docs.withColumn(own_, own).join(scratch.save(plan, "plan"), F.col(f"`{source}`").eqNullSafe(F.col(source_)))
    return met.withColumn(again, F.explode(F.array_repeat(F.lit(True), times))).select(*[F.col(f"`{c}`") for c in docs.columns])
