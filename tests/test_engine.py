"""Every query against its SQL, and golden cases of what SQL cannot express."""

import json
import os
import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from vidsift import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    return con


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(float(r[i])) if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = df.collect()
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(df.columns)
        assert counted(df.columns, rows) == counted(columns, want.fetchall())
    else:
        assert rows


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(column(F.col("v"))).collect()]


def test_text_functions(spark):
    from vidsift.functions import ocr, text, times

    assert one(spark, text.domain_slug, "abcnews.go.com", "cdn29.elitedaily.com", "http://www.popmatters.com/feeds/", "latimes.com", "x") == ["abcnews", "elitedaily", "popmatters", "latimes", ""]
    assert one(spark, text.keyword_list, '["news","trump"]', "a, B,,a", None) == [["news", "trump"], ["a", "b"], []]
    assert one(spark, lambda c: text.merge_lists(text.keyword_list(c), F.array(F.lit("trump"), F.lit("ice"))), '["news","trump"]') == [["news", "trump", "ice"]]
    assert one(spark, text.handle, " @@Some ", None) == ["some", None]
    assert one(spark, text.username_from, "https://www.example.com/@Some.User?x=1", "@Name_1", "plain", "bad name", "https://x.example/@two/video/3") == ["some.user", "name_1", "plain", "", "two"]
    assert one(spark, text.webvtt_text, "WEBVTT\n\nNOTE x\n1\n00:00.000 --> 00:01.000\nHello\nthere\n\n2\n00:01.000 --> 00:02.000\nthere\nall\n") == ["Hello there all"]
    assert one(spark, text.unfenced_json, '```json\n["a"]\n```', "[]") == ['["a"]', "[]"]
    assert one(spark, text.sticker_text, '[{"sticker_name":" Hi "},{"sticker_name":""},{"sticker_name":"There"}]', "[]", "bad", None) == ["Hi | There", "", None, None]
    assert one(spark, text.keyword_list, '["News","trump","news"]', "Trump, ice ,,ICE", "solo", "") == [["news", "trump"], ["trump", "ice"], ["solo"], []]
    assert one(spark, ocr.clean, "TRU\nMP CALLED", "THE\nCREW", "govern-\nment says", "a line\n\r\nthat goes on", "", None) == ["TRUMP CALLED", "THECREW", "government says", "a line that goes on", "", ""]
    assert one(spark, ocr.clean, "One short\nTwo short\n" + "Xx" * 41 + "\nEnd.", "BIG\nNEWS DAY TODAY OK") == ["One short Two short\n" + "Xx" * 41 + "\nEnd.", "BIGNEWS DAY TODAY OK"]
    assert one(spark, ocr.garbage, "B 1000", "0 6 G", "", "II", "AMERICA 250", "Breaking news today", "follow", None, "Share!", "日本 5") == [True, True, True, True, False, False, True, True, True, True]
    assert one(spark, ocr.strip_ui, "12", "AMERICA 250", "A 1000 top story", "B 1000 top story", "  ", "like 5  k 7 x") == ["", "AMERICA 250", "top story", "1000 top story", "", "like"]
    frames = ["AMERICA 250 Governor speaks at rally", "AMERICA 250 something else entirely new", "AMERICA 250 third caption follows here"]
    f = spark.createDataFrame([(1, i, x) for i, x in enumerate(frames)] + [(2, 0, "Only one"), (3, 0, None)], "v int, at int, t string")
    assert {r.v: r.phrases for r in ocr.persistent_phrases(f, "v", "t").collect()} == {1: ["AMERICA 250"]}
    got = {r.v: r.collapsed for r in ocr.collapse(f, "v", "at", "t").collect()}
    assert sorted(got) == [1, 2] and "AMERICA 250" in got[1] and got[2] == "Only one"
    assert one(spark, lambda c: ocr.strip_phrases(c, F.array(F.lit("BIG (NEWS)"), F.lit("SALE"))), "big (news) , today sale.", None) == ["today", ""]
    kept = ocr.Kept()
    assert [kept.add(x) for x in ("one two three four", "one two three four", "", "another text", "x" * 60, "x" * 45, "y" + "x" * 60 + "z")] == [True, False, False, True, True, False, False]
    hours = spark.createDataFrame([("2026-03-08",), ("2026-08-13",), ("2026-11-01",)], "d string")
    a, b = times.civil_window(F.col("d").cast("date"), "America/Chicago")
    assert [r[0] for r in hours.select(((F.unix_seconds(b) - F.unix_seconds(a)) / 3600).cast("int")).collect()] == [23, 24, 25]


def test_emoji(spark):
    from vidsift.functions import emoji

    got = {(r.id, r.emoji): (r["count"], r.emoji_category) for r in emoji.emoji_rows(spark.createDataFrame([(1, "🔥 Breaking 🔥"), (2, "😂 lol ❤️"), (3, None)], "id int, t string"), "id", {"caption": F.col("t")}).collect()}
    assert got == {(1, "🔥"): (2, "emphasis"), (2, "😂"): (1, "emotion")}
    assert one(spark, lambda c: emoji.glyphs(c, strict=False), "lol ❤️") == [["❤️"]]


def test_upserts(spark):
    from vidsift.operators import upserts as U

    t = spark.createDataFrame([(1, "a", ["news"], "pipeline_1"), (2, "", ["x"], "pipeline_3")], "id int, text string, kw array<string>, pipeline string")
    r = spark.createDataFrame([(1, "b", ["trump"], "keyword"), (2, "c", ["x", "y"], "keyword"), (3, "d", ["z"], "keyword")], t.schema)
    merge = lambda x: U.merge_with_provenance(x, r, "id", F.col("t.pipeline") == "pipeline_1", ["pipeline"], [], ["text"], "kw")
    once = sorted(map(tuple, merge(t).collect()))
    assert once == [(1, "a", ["news", "trump"], "pipeline_1"), (2, "c", ["x", "y"], "keyword"), (3, "d", ["z"], "keyword")]
    assert sorted(map(tuple, merge(merge(t)).collect())) == once
    twice = U.replace_by_key(U.replace_by_key(t, r, "id", [F.asc("text")]), r, "id", [F.asc("text")])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, r.collect()))


def test_sources_and_sinks(spark, tmp_path):
    from vidsift.sources import readers, schemas, writers

    (tmp_path / "handles.txt").write_text("# note\n@One\ntwo \n\nONE\n")
    assert [tuple(r) for r in readers.listed(spark, str(tmp_path / "handles.txt")).collect()] == [(0, "one"), (1, "two")]
    (tmp_path / "k.csv").write_text("id,term\n1,Ice\n2,trump\n3,ICE\n")
    assert [r.value for r in readers.keywords(spark, str(tmp_path / "k.csv")).orderBy("place").collect()] == ["ice", "trump"]
    (tmp_path / "loose.csv").write_text("﻿ Outlet  Name,Usable (human review)\nA, yes \n", encoding="utf-8")
    assert [tuple(r) for r in readers.loose_csv(spark, str(tmp_path / "loose.csv"), {"outlet": "outlet name", "usable": "usable", "x": "none"}).collect()] == [("A", "yes", None)]
    (tmp_path / "raw.jsonl").write_text('{"timestamp":"t","http_status":200}\nbroken\n')
    raw = readers.raw_responses(spark, str(tmp_path / "raw.jsonl")).cache()
    assert raw.where("_corrupt_record is not null").count() == 1 and raw.where("http_status = 200").count() == 1
    path = str(tmp_path / "table")
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    for _ in range(2):
        writers.upsert(d, path, "id", [F.asc("v")])
    writers.upsert(spark.createDataFrame([(2, "c"), (3, "d")], d.schema), path, "id", [F.asc("v")])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    day = spark.createDataFrame([("2026-09-01", "x", ["a", "b"], None)], "collection_date string, video_id string, kw array<string>, n int")
    shaped = writers.csv_shape(day, schemas.STATUS_FIRST)
    assert shaped.columns == ["collection_date", "video_id", "kw", "n"] and tuple(shaped.first()) == ("2026-09-01", "x", "a|b", "")
    for _ in range(2):
        writers.dated(day, str(tmp_path / "days"))
    assert spark.read.parquet(str(tmp_path / "days")).count() == 1
    assert schemas.drift(day, schemas.VIDEO)["extra"] == ["kw", "n"]
    assert writers.gate(day.withColumn("collection_status", F.lit("ok")), "2026-09-01", 1).first().reason == "fewer failed rows than failed handles"
    page = spark.createDataFrame([('<script id="__UNIVERSAL_DATA__">{"item":{"a":1}}</script>',), ("none",)], "html string")
    assert [r.item for r in readers.hydration(page).collect()] == ['{"a":1}', None]


def test_streaming(spark, tmp_path):
    from vidsift.streaming import events as S

    spark.read.parquet(f"{SF}/events.parquet").repartition(2).write.parquet(str(tmp_path / "in"))
    q = S.hourly(S.distinct_events(S.log_stream(spark, str(tmp_path / "in"))), None).writeStream.outputMode("append").format("memory").queryName("hourly").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("hourly").count() > 0
    out = str(tmp_path / "state")
    q = S.log_stream(spark, str(tmp_path / "in")).writeStream.foreachBatch(S.upsert_sink(out, "user_id", "event_id")).option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = spark.read.parquet(f"{SF}/events.parquet").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    assert sorted(map(tuple, spark.read.parquet(out).select("user_id", "event_id").collect())) == sorted(map(tuple, want.collect()))


def kept_by_pairs(keys, within, least, any_inside):
    """Every key against all kept ones."""
    held = []
    for k in keys:
        own = set(re.findall("[a-z0-9]{2,}", k))
        for h in held:
            other = set(re.findall("[a-z0-9]{2,}", h))
            inside = (len(k) > within and (k in h or (any_inside and h in k))) or (not any_inside and len(h) > within and h in k)
            if k == h or inside or (own and other and len(own & other) / len(own | other) >= least):
                break
        else:
            if k:
                held.append(k)
    return held


@pytest.mark.parametrize("rule", [(40, 0.88, False), (30, 0.8, True), (5, 0.5, False)])
def test_kept_frames_against_all_pairs(rule):
    import random

    from vidsift.functions.ocr import Kept

    rng = random.Random(7)
    for _ in range(40):
        base = [f"w{rng.randrange(30)}" for _ in range(12)]
        keys = []
        for _ in range(60):
            k = list(base)
            for _ in range(rng.randrange(5)):
                k[rng.randrange(len(k))] = f"w{rng.randrange(30)}"
            a = rng.randrange(6)
            keys.append(" ".join(k[a : a + rng.randrange(1, 13)]))
        kept = Kept(*rule)
        assert [k for k in keys if kept.add(k)] == kept_by_pairs(keys, *rule)


def test_all_lines_are_frames(spark, tmp_path):
    import vidsift.plans.texts as T

    lines = [f"{w} report number {w}{w} of the evening" for w in "alpha bravo candle delta ember forest garden harbor island jungle kernel lantern marble needle orchid".split()]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string").write.parquet(path)
    assert sorted(r.frame for r in T.t35_frame_dedupe(spark, str(tmp_path)).collect()) == list(range(15))
    r = T.a22_ocr_rollup(spark, str(tmp_path)).first()
    assert r.frames_in == 15 and lines[14] in r.raw_text


def test_plans(spark):
    plan = lambda name: registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan("j05_anti_needs_work") and "LeftSemi" in plan("j07_semi_any_of")
    assert "PushedFilters: [IsNotNull(ts)" in plan("p11_half_open_range") and "ReadSchema: struct<doc_id:bigint,lang:string" in plan("p09_in_array_parameter")


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100 and json.dumps(sorted(e.queries()))


def test_entry_without_the_optional_parts(tmp_path):
    """With the folders of the training-data operators gone, with and without their pipeline, the rest still works."""
    root = Path(__file__).resolve().parent.parent
    for gone in ([], ["corpus_pipeline.py"]):
        at = tmp_path / f"copy{len(gone)}"
        shutil.copytree(root, at, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.pyc", *gone))
        code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and len(q) > 100 and 'pipeline' not in q and not [n for n in q if n.startswith('op1')]"
        subprocess.run([sys.executable, "-c", code], cwd=at, check=True, timeout=120, env=os.environ | {"PYTHONPATH": str(at)})
