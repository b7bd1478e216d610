"""Stored tables, checked exports, JSON of any depth, emoji sequences: cases beside the registered queries."""

import json
import os
import random

import pytest
import regex


def one(spark, column, *values):
    from pyspark.sql import functions as F

    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column(F.col("v"))).collect()]


def test_exports_are_refused_unless_whole(spark, tmp_path):
    from vidsift.sources import stores

    schema = "id int, collection_date string, collection_status string, note string"
    rows = [(i, "2024-02-01", "api_failed" if i < 2 else "ok", 'a "b"\nnext, line' if i % 2 else None) for i in range(50)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    path = f"{tmp_path}/a"
    counts = stores.export(df, path, "2024-02-01", ("collection_status",), least_failed=2)
    assert counts == {"rows": 50, "other_days": 0, "failed": 2, "read_back": 50}
    columns = ["collection_status", "id", "collection_date", "note"]
    with pytest.raises(ValueError, match="failed rows"):
        stores.export(df, f"{tmp_path}/b", "2024-02-01", least_failed=3)
    with pytest.raises(ValueError, match="other days"):
        stores.export(df, f"{tmp_path}/c", "2024-02-02")
    with pytest.raises(ValueError, match="no rows"):
        stores.export(df.limit(0), f"{tmp_path}/d", "2024-02-01", least_failed=1)
    with pytest.raises(ValueError, match="header"):
        stores.verify(spark, path, counts, columns[::-1], "2024-02-01")
    part = max((f"{path}/{f}" for f in os.listdir(path) if f.endswith(".csv")), key=os.path.getsize)
    whole = open(part).read()
    open(part, "w").write(whole[: len(whole) // 2])
    crc = f"{path}/.{os.path.basename(part)}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(ValueError, match="read back"):
        stores.verify(spark, path, counts, columns, "2024-02-01")


def test_a_byte_order_mark_opens_each_file(spark, tmp_path):
    from vidsift.sources import writers

    df = spark.range(6).selectExpr("id", "'x' AS s").repartition(2)
    for mark in (True, False):
        writers.write_csv(df, f"{tmp_path}/{mark}", ("s",), mark=mark)
        files = [f"{tmp_path}/{mark}/{f}" for f in os.listdir(f"{tmp_path}/{mark}") if f.endswith(".csv")]
        assert len(files) == 2 and all(open(f, "rb").read().startswith(b"\xef\xbb\xbfs,id" if mark else b"s,id") for f in files)


def test_archive_replaces_and_keeps_on_failure(spark, tmp_path, monkeypatch):
    from vidsift.sources import stores

    for name, n in (("a", 10), ("b", 20)):
        spark.range(n).write.csv(f"{tmp_path}/{name}")
    first = stores.archive(spark, f"{tmp_path}/a", f"{tmp_path}/arch", "p1_x", "2024-02-01")
    again = stores.archive(spark, f"{tmp_path}/b", f"{tmp_path}/arch", "p1_x", "2024-02-01")
    assert (first["replaced"], again["replaced"]) == (False, True) and again["bytes"] > first["bytes"] > 0
    assert spark.read.csv(again["uri"]).count() == 20
    with pytest.raises(ValueError):
        stores.archive(spark, f"{tmp_path}/a", f"{tmp_path}/arch", "p1_x", "20240201")
    real = stores.stored_bytes
    monkeypatch.setattr(stores, "stored_bytes", lambda s, p: real(s, p) - ("/_2024" in p))
    with pytest.raises(OSError, match="bytes arrived"):
        stores.archive(spark, f"{tmp_path}/a", f"{tmp_path}/arch", "p1_x", "2024-02-01")
    assert spark.read.csv(again["uri"]).count() == 20


def test_lookups_read_few_folders(spark, tmp_path):
    from vidsift.sources import stores

    rows = [(i % 40, i, f"2024-0{1 + i % 5}-03") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, n long, day string").selectExpr("id", "n", "cast(day as date) AS at")
    stores.lay_out(df, "id", "at", f"{tmp_path}/s")
    store = spark.read.schema("id long, n long, at date, chunk int, slot int").parquet(f"{tmp_path}/s")
    wanted = spark.createDataFrame([(7,), (7,), (None,), (99,)], "id long")
    found = stores.lookup(store.where("chunk >= 658"), "id", wanted)
    plan = found._jdf.queryExecution().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "chunk" in filters and "slot" in filters.split("PartitionFilters")[1]
    got = stores.newest_first(store, "id", wanted, ["at", "n"]).collect()
    best = max((r[2], r[1]) for r in rows if r[0] == 7)
    assert [(r.id, r.n) for r in got] == [(7, best[1])]
    assert stores.newest_first(store, "id", wanted.limit(0), ["at", "n"]).count() == 0


def test_columns_are_added_once(spark, tmp_path):
    from vidsift.sources import stores

    name = stores.stored_table(spark, "t", "a INT, b STRING", f"{tmp_path}/t")
    spark.createDataFrame([(1, "x")], "a int, b string").write.insertInto(name)
    assert stores.add_missing_columns(spark, name, "B STRING, c ARRAY<STRUCT<x: INT>>, d DOUBLE") == ["c", "d"]
    assert stores.add_missing_columns(spark, name, "c ARRAY<STRUCT<x: INT>>") == []
    spark.sql(f"INSERT INTO {name} VALUES (2, 'y', array(named_struct('x', 5)), 1.5)")
    got = sorted((r.a, r.b, r.c and r.c[0].x, r.d) for r in spark.table(name).collect())
    assert got == [(1, "x", None, None), (2, "y", 5, 1.5)]


def walk(node, at=""):
    """The paths of a search for 'ab', written apart from it."""
    if isinstance(node, dict):
        for k, v in node.items():
            here = f"{at}.{k}" if at else k
            if "ab" in k.lower():
                yield here, "key"
            if isinstance(v, str) and len(v) > 2 and "ab" in v.lower():
                yield here, "value"
            yield from walk(v, here)
    elif isinstance(node, list):
        for i, v in enumerate(node):
            yield from walk(v, f"{at}[{i}]")


def test_search_of_any_depth(spark):
    from vidsift.functions import variants

    rng = random.Random(4)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["ab", "xAByz", "no", 5, None, True, 1.5, []])
        if rng.random() < 0.5:
            return [tree(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["ab", "cAb", "k", "v w"]) + str(i): tree(depth - 1) for i in range(rng.randrange(4))}

    texts = [json.dumps(tree(6)) for _ in range(40)]
    deep = '{"k":' * 120 + '"x ab"' + "}" * 120
    rows = list(enumerate([*texts, deep, "{broken", None, '"ab ab"', '{"ab":1}']))
    got = variants.search(spark.createDataFrame(rows, "id long, j string"), "id", "j", ["AB"]).collect()
    want = []
    for i, t in rows:
        if t and t != "{broken" and t != deep:
            want += [(i, *h) for h in walk(json.loads(t))]
    want += [(len(texts), ".".join(["k"] * 120), "value")]
    assert sorted(map(tuple, got)) == sorted(want)


def test_hydration_of_odd_pages(spark):
    from pyspark.sql import functions as F

    from vidsift.functions import variants as V

    page = lambda j: f'<html><script id="{V.SCRIPT_ID}">{j}</script>'
    item = {"id": 5, "author": {"uniqueId": ""}, "stickersOnItem": [{"stickerText": [" a ", None, ""]}, {}, {"stickerText": None}], "video": {"claInfo": {"captionInfos": [{"url": "", "Url": "u1"}, {"language": "en"}]}, "subtitleInfos": [{"url": "u1"}, {"url": "u2"}, {"Url": "u2"}]}}
    wrap = lambda x: json.dumps({"__DEFAULT_SCOPE__": {"webapp.video-detail": {"itemInfo": {"itemStruct": x}}}})
    rows = [(1, page(wrap(item))), (2, page("{")), (3, "<html>"), (4, None), (5, page(wrap(None))), (6, page("[1]")), (7, page(wrap({"id": "7", "stickersOnItem": "text", "video": []})))]
    df = spark.createDataFrame(rows, "n int, html string").select("n", V.item_of(V.script_blob(F.col("html"))).alias("item"))
    got = {r.n: r for r in df.select("n", *V.record(F.col("item"), F.lit("url"), "site")).collect()}
    assert (got[1].video_id, got[1].username, got[1].onscreen_text, got[1].canonical_url) == ("5", "", "a", "url")
    assert got[1].tracks == "||u1\n|subtitleInfos|u2" and got[1].has_stickers
    assert all(got[n].error == "hydration_item_struct_missing" and got[n].video_id is None for n in (2, 3, 4, 6))
    assert got[7].video_id == "7" and got[7].tracks == "" and not got[7].has_stickers


def test_emoji_sequences_are_grapheme_clusters(spark):
    from vidsift.functions import emoji

    whole = ["👨‍👩‍👧‍👦", "1️⃣", "👍🏽", "🇺🇸", "🏴󠁧󠁢󠁥󠁮󠁧󠁿", "❤️", "👩🏾‍🚀", "☀️", "🏳️‍🌈", "🙋🏻‍♀️", "🔥", "⭐"]
    rng = random.Random(1)
    texts = ["".join(rng.choice([*whole, " word ", "x", "é", "5", "。"]) for _ in range(12)) for _ in range(200)]
    want = [[g for g in regex.findall(r"\X", t) if g in whole] for t in texts]
    assert one(spark, emoji.sequences, *texts) == want
    assert one(spark, emoji.sequences, None, "", "✔️ © 12", "no") == [[], [], [], []]


def test_keep_best_keeps_ties(spark):
    from pyspark.sql import functions as F

    from vidsift.operators.relational import keep_best

    rows = [(1, 5, "a", 1), (1, 5, None, 2), (1, 5, "a", 3), (1, 4, "z", 4), (2, None, "q", 5), (2, None, "q", 6), (None, 1, "a", 7)]
    df = spark.createDataFrame(rows, "k int, d int, s string, n int")
    got = keep_best(df, "k", {"d": F.col("d"), "s": F.coalesce("s", F.lit(""))})
    assert sorted(r.n for r in got.collect()) == [1, 3, 5, 6] and got.columns == df.columns


def test_reading_order(spark):
    from pyspark.sql import functions as F

    from vidsift.functions import annotations as A

    w = lambda *t: {"symbols": [{"text": x} for x in t]}
    block = lambda *paras: {"paragraphs": [{"words": list(p)} for p in paras]}
    raws = [
        json.dumps({"pages": [{"blocks": [block([w("H", "i"), w("you")], [w("b")]), block([]), block([w("")])]}, {"blocks": [block([w("c")])]}, {}], "text": "other"}),
        json.dumps({"pages": [], "text": " own "}),
        json.dumps({"pages": None, "text": None}),
        "{",
        None,
    ]
    assert one(spark, lambda c: A.reading_order(F.from_json(c, A.ANNOTATION)), *raws) == ["Hi you\nb\n\nc", "own", "", "", ""]


def test_sql_functions(spark):
    from vidsift.functions import sql

    sql.register(spark)
    assert spark.sql("SELECT vidsift_leading(k, n) AS l FROM VALUES ('b', 2), ('a', 2), ('c', 1), ('c', 0) t(k, n)").first().l == "a|b"
    rows = spark.sql("SELECT x.* FROM VALUES ('a b\n\n c'), (''), (NULL) t(s), LATERAL vidsift_lines(t.s) x").collect()
    assert sorted(map(tuple, rows)) == [(1, 2, "a"), (3, 1, "c")]
