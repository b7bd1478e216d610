"""Pairs of sets that can reach an overlap: prefix filter over hashed elements, parity sketches, no pair of others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 512  # of a parity sketch
FREQUENT = 65_536  # elements whose counts order the prefixes; all others count as rare
SHARE = 4_096  # sets with a frequent element that one task pairs


def prefixes(sets: DataFrame, key: str, of: str, elements: str, num: int, den: int) -> DataFrame:
    """(key, of, size, sketch, w, rest, often): of each set the elements that a pair needs to meet, and its parity sketch.

    ``elements`` are 64-bit hashes in an order that depends on the elements only; ``of`` is a hash of the group whose sets
    are compared. Any one order of elements gives the same pairs; rare first gives few candidates, so the counts of the
    most frequent ones are enough. A set's row in the sketch is the parity of its elements by their low bits: two sets
    differ in at least as many elements as their sketches in bits.
    """
    counts = sets.select(F.explode(elements).alias("w")).groupBy("w").count().where("count > 1").orderBy(F.desc("count"), "w").limit(FREQUENT).toPandas()
    counts = counts.sort_values("w")
    known, times = counts["w"].to_numpy("int64"), counts["count"].to_numpy("int64")
    share = num / den

    def run(batches):
        for b in batches:
            lists = b.column(elements)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
            w = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            often = np.zeros(len(w), "int64")
            if len(known):
                at = np.minimum(np.searchsorted(known, w), len(known) - 1)
                often = np.where(known[at] == w, times[at], 0)
            order = np.lexsort((w, often, row))
            place = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size)
            longest = size - np.ceil(share * size - 1e-9).astype("int64") + 1
            keep = place < longest[row]
            bits = np.bincount(row * BITS + (w & (BITS - 1)), minlength=len(size) * BITS) & 1
            sketch = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(bits.astype("uint8").reshape(-1, BITS), axis=1).reshape(-1).view("int64")), BITS // 64).cast(pa.list_(pa.int64()))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(size)))]).astype("int32")
            kept = order[keep]
            entry = pa.StructArray.from_arrays([pa.array(w[kept]), pa.array((size[row] - place - 1)[keep].astype("int32")), pa.array(often[kept])], ["w", "rest", "often"])
            yield pa.RecordBatch.from_arrays([b.column(key), b.column(of), pa.array(size.astype("int32")), sketch, pa.ListArray.from_arrays(pa.array(ends), entry)], [key, of, "size", "sketch", "prefix"])

    kind = sets.schema[key].dataType.simpleString()
    return sets.select(key, of, elements).mapInArrow(run, f"{key} {kind}, {of} long, size int, sketch array<long>, prefix array<struct<w: long, rest: int, often: long>>")


def candidates(made: DataFrame, key: str, num: int, den: int) -> DataFrame:
    """(a, b): different sets of ``prefixes``, a before b, whose overlap can be num / den of their union; each pair once.

    The smaller set meets on its shorter prefix, sizes and what is left behind the shared element can reach the overlap,
    and sketches differ in no more bits than the sets may in elements. Sets with a frequent element are dealt over tasks.
    """
    each = made.select(key, "size", "of", F.explode("prefix").alias("p")).select(key, "size", F.xxhash64("of", "p.w").alias("w"), "p.rest", F.least(F.lit(64), F.floor(F.col("p.often") / SHARE) + 1).cast("int").alias("parts"))
    # of two sets the smaller holds the first shared element among its n - ceil(2 num n / (num + den)) + 1 rarest
    x = each.where(f"size - rest - 1 < size - ceil({2 * num} * size / {num + den}.0D - 1e-9D) + 1").withColumn("salt", F.pmod(F.xxhash64(key), F.col("parts")).cast("int")).drop("parts").alias("x")
    y = each.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").alias("y")
    first = F.col("x.size") < F.col("y.size")
    first = first | ((F.col("x.size") == F.col("y.size")) & (F.col(f"x.{key}") < F.col(f"y.{key}")))
    fits = (F.col("x.w") == F.col("y.w")) & (F.col("x.salt") == F.col("y.salt")) & first & F.expr(f"{den} * x.size >= {num} * y.size")
    # the first shared element and what is behind it in both must reach num / (num + den) of both sizes
    fits = fits & F.expr(f"{num + den} * (1 + least(x.rest, y.rest)) >= {num} * (x.size + y.size)")
    met = x.join(y.hint("merge"), fits).select(F.least(f"x.{key}", f"y.{key}").alias("a"), F.greatest(f"x.{key}", f"y.{key}").alias("b")).distinct()
    side = lambda i: made.select(F.col(key).alias(i), F.col("size").alias(f"n{i}"), F.col("sketch").alias(f"s{i}"))
    both = met.join(side("a"), "a").join(side("b"), "b")
    return both.where(_differing("sa", "sb") * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b")


def _differing(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
