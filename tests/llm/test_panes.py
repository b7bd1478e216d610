"""Window panes with revisions against a plain simulation and against SQL."""

import random
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa

HOUR, DAY = 3_600_000_000, 86_400_000_000
SF = "/root/testdata/sf0.001"


def simulate(rows, n_batches, grace=6, keep=96):
    """The rows of revisions(), from its definition; rows: (batch, kind, event_us, click_id, cents)."""
    out, panes, seen = [], {}, None
    for batch in range(n_batches):
        mine = [r for r in rows if r[0] == batch and r[2] is not None]
        touched = set()
        due = lambda hour, hours: seen is not None and seen >= (hour + 1 + hours) * HOUR  # noqa: E731, B023
        for _, kind, at, click, cents in mine:
            key = (kind or "none", at // HOUR)
            if due(key[1], keep):
                out.append((batch, "late", *key, click, 1, cents or 0))
                continue
            p = panes.setdefault(key, {"n": 0, "c": 0, "out": None})
            p["n"], p["c"] = p["n"] + 1, p["c"] + (cents or 0)
            touched.add(key)
        for key, p in list(panes.items()):
            if p["out"] is None and due(key[1], grace):
                out.append((batch, "emit", *key, -1, p["n"], p["c"]))
                p["out"] = (p["n"], p["c"])
            elif p["out"] is not None and key in touched:
                out += [(batch, "retract", *key, -1, *p["out"]), (batch, "replace", *key, -1, p["n"], p["c"])]
                p["out"] = (p["n"], p["c"])
            if due(key[1], keep):
                del panes[key]
        if mine:
            seen = max(r[2] for r in mine) if seen is None else max(seen, max(r[2] for r in mine))
    return out + [(n_batches - 1, "final", *key, -1, p["n"], p["c"]) for key, p in panes.items() if p["out"] is None]


def test_revisions(spark):
    """Watermarks that equal a bound to the microsecond or miss it by one, hours before 1970, an empty batch, nulls."""
    from vidsift.llm import panes

    rng = random.Random(2)
    # hour 0 ends at 1 h: due at 7 h, closed at 97 h
    rows = [(0, "a", 5, 1, 10), (0, "a", 6, 2, None), (0, None, -3 * HOUR, 3, 7), (0, "b", 7 * HOUR - 1, 4, 1), (0, "a", None, 5, 1)]
    rows += [(1, "a", 7, 6, -4), (1, "c", 7 * HOUR, 7, 1)]  # batch 1 sees 7 h - 1 us: nothing of hour 0 is due
    rows += [(3, "a", 8, 8, 5), (3, "c", 97 * HOUR, 9, 1), (3, "late", -(10**6) * HOUR, 10, 3)]  # due in the empty batch 2; corrected in 3
    rows += [(4, "a", 9, 11, 5), (4, "a", 9, 11, 5), (4, "b", HOUR, 12, 2)]  # batch 4 sees 97 h: hour 0 is closed, hour 1 is not
    rows += [(rng.randrange(5), rng.choice("xyz"), rng.randrange(-50 * HOUR, 150 * HOUR), 100 + i, rng.randrange(-9, 99)) for i in range(150)]
    df = spark.createDataFrame(rows, "batch int, kind string, event_us long, click_id long, cents long")
    got = panes.revisions(df, 5)
    assert got.columns == ["batch", "record", "kind", "hour", "click_id", "n_rows", "cents"]
    assert Counter(map(tuple, got.collect())) == Counter(simulate(rows, 5))
    assert {r[1] for r in simulate(rows, 5)} == {"late", "emit", "retract", "replace", "final"}
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_no_rows(spark):
    from vidsift.llm import panes

    df = spark.createDataFrame([(0, "a", None, 1, 1), (None, "a", 1, 1, 1)], "batch int, kind string, event_us long, click_id long, cents long")
    assert panes.revisions(df, 2).count() == 0


def test_rows_are_added_up_before_the_shuffle():
    from vidsift.llm import panes

    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(-9, 200), rng.choice([None, 7, 8]), rng.randrange(50), rng.random() < 0.01) for _ in range(3000)]
    batches = [pa.record_batch([pa.array(x) for x in zip(*rows[i : i + 500], strict=True)], names=["kind", "hour", "click_id", "cents", "sentinel"]) for i in range(0, 3000, 500)]
    for closed, pending in ((None, 100_000), (150 * HOUR, 100_000), (150 * HOUR, 40)):
        out = [r for b in panes.combine(batches, closed, 96 * HOUR, pending) for r in b.to_pylist()]
        late = lambda h: closed is not None and (h + 97) * HOUR <= closed  # noqa: E731, B023
        want, single = defaultdict(lambda: [0, 0]), Counter()
        for kind, hour, click, cents, sentinel in rows:
            if sentinel or late(hour):
                single[kind, hour, click, cents] += 1
            else:
                want[kind, hour][0] += 1
                want[kind, hour][1] += cents
        have = defaultdict(lambda: [0, 0])
        for r in out:
            if r["lane"] == 0:
                have[r["kind"], r["hour"]][0] += r["n_rows"]
                have[r["kind"], r["hour"]][1] += r["cents"]
        assert have == want
        assert Counter((r["kind"], r["hour"], r["click_id"], r["cents"]) for r in out if r["lane"] != 0) == single
        if pending > 40:
            assert sum(r["lane"] == 0 for r in out) == len(want)


def test_query_equals_sql(spark):
    from vidsift.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW clicks AS SELECT * FROM read_parquet('{SF}/clicks.parquet')")
    want = con.execute(queries.ORACLE_SQL["op13_pane_revisions"])
    columns = [d[0] for d in want.description]
    got = queries.op13_pane_revisions(spark, SF).select(columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_click_batches(spark):
    """Nulls, repeated ids, values that are no numbers, times before 1970."""
    from datetime import datetime as d

    from vidsift.llm import queries

    nan = float("nan")
    rows = [(1, d(2024, 1, 1), d(2024, 1, 2), "k", 1.005), (1, d(2024, 1, 1), d(2024, 1, 2), "k", 1.005), (1, d(2024, 1, 3), d(2024, 1, 3), "k", 5.0), (2, None, d(2024, 1, 2), "k", 1.0), (3, d(1969, 12, 31, 23, 59, 59, 999999), d(1970, 1, 9), None, nan), (None, d(2024, 1, 1), None, "x", None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, kind string, value double, batch int")
    got = {r.click_id: r for r in queries.click_batches(df).collect()}
    assert set(got) == {1, 3, None} and got[1].cents == 100
    assert got[3].event_us == -1 - 8 * DAY and got[3].cents == 0 and got[3].kind is None
    assert got[None].cents == 0 and got[1].batch >= 19724 % 8 - 1
