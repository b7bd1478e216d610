"""Prefixes and sketches lose no pair of sets, and leave few that are not alike."""

import random

from pyspark.sql import functions as F


def test_candidates_against_all_pairs(spark):
    from vidsift.operators import overlaps as V

    rng = random.Random(5)
    sets = {}
    for i in range(300):
        near = [] if i % 3 == 0 else [w for w in sorted(sets[i - 1][1]) if rng.random() < rng.choice([0.8, 0.9, 0.95, 1.0])]
        size = rng.choice([1, 2, 5, 9, 30, 200])
        sets[i] = (i // 3 % 2 if i // 3 % 7 else None, set(near) | {f"w{min(rng.randrange(900), rng.randrange(900))}" for _ in range(size if not near else rng.randrange(1, 4))})
    rows = [(i, of, sorted(t)) for i, (of, t) in sets.items()]
    df = spark.createDataFrame(rows, "id long, g int, t array<string>")
    hashed = df.select("id", F.xxhash64("g").alias("of"), F.transform("t", lambda w: F.xxhash64(w)).alias("t"))
    got = {tuple(r) for r in V.candidates(V.prefixes(hashed, "id", "of", "t", 4, 5), "id", 4, 5).collect()}
    group = lambda i, j: sets[i][0] == sets[j][0]
    want = {(i, j) for i in sets for j in sets if i < j and group(i, j) and 5 * len(sets[i][1] & sets[j][1]) >= 4 * len(sets[i][1] | sets[j][1])}
    assert len(want) > 30 and want <= got and len(got) < 4 * len(want)


def test_large_sets_with_common_words_are_ruled_out_by_their_sketches(spark):
    from vidsift.operators import overlaps as V

    rng = random.Random(6)
    rows = [(i, 0, rng.sample(range(1, 700), 350)) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, of long, t array<long>").withColumn("t", F.transform("t", lambda w: F.xxhash64(w)))
    assert V.candidates(V.prefixes(df, "id", "of", "t", 4, 5), "id", 4, 5).count() == 0
