"""Keyed streaming state against a plain state machine, and sinks that are run again."""

import random

import pytest


def machine(rows):
    """(status, cursor, pages, error, skipped) of a unit, from its pages in order."""
    status, cursor, pages, error, skipped = "running", None, 0, None, 0
    for _, event, kind, detail in sorted(rows):
        if status in ("completed", "failed"):
            skipped += 1
        elif kind == "error":
            status, error = ("partial" if pages else "failed"), detail
        else:
            pages, cursor = pages + 1, event
            if kind == "last":
                status, error = "completed", None
    return status, cursor, pages, error, skipped


def log(rng, units, n):
    rows = [(f"u{rng.randrange(units)}", i // 2, i, rng.choice(["page"] * 5 + ["error", "last"]), f"d{i}") for i in range(n)]
    return rows


def run(spark, rows, batches, folder):
    from vidsift.streaming import progress as P
    from vidsift.streaming.replay import replay

    df = spark.createDataFrame([(*r, i * batches // len(rows)) for i, r in enumerate(rows)], "unit string, at long, event_id long, kind string, detail string, batch int")
    replay(df, "batch", batches, folder, lambda s: P.follow(s, f"{folder}/states", f"{folder}/checkpoint"))
    return spark.read.schema(P.PROGRESS).parquet(f"{folder}/states")


def test_progress_resumes_after_any_batch(spark, tmp_path):
    from vidsift.streaming import progress as P

    rows = log(random.Random(3), 40, 400)
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(r[1:])
    want = {u: machine(x) for u, x in want.items()}
    for batches in (1, 3):
        states = run(spark, rows, batches, f"{tmp_path}/{batches}")
        assert {r.unit: (r.status, r.cursor, r.pages, r.error, r.skipped) for r in P.current(states).collect()} == want
    assert {v[0] for v in want.values()} >= {"completed", "failed", "partial"}
    units = spark.createDataFrame([(u,) for u in [*want, "new"]], "unit string")
    left = {r.unit: r.cursor for r in P.resume(units, states).collect()}
    assert left == {"new": None} | {u: v[1] for u, v in want.items() if v[0] in ("partial", "running")}
    assert {r.unit for r in P.resume(units, states, retry_failed=True).collect()} - set(left) == {u for u, v in want.items() if v[0] == "failed"}


def test_breaker_stops_by_run_and_by_rate(spark, tmp_path):
    from vidsift.streaming import progress as P
    from vidsift.streaming.replay import replay

    rng, rows = random.Random(9), []
    for c in range(12):
        share = c / 14
        rows += [(c, i, c * 1000 + i, "error" if rng.random() < share else "page") for i in range(60)]
    df = spark.createDataFrame([(*r, r[1] // 20) for r in rows], "collector long, at long, event_id long, kind string, batch int")
    replay(df, "batch", 3, str(tmp_path), lambda s: P.guard(s, f"{tmp_path}/out", f"{tmp_path}/checkpoint", in_a_row=4, least=25, rate=0.4))
    want = []
    for c in range(12):
        bad = tried = streak = 0
        for _, _, event, kind in [r for r in rows if r[0] == c]:
            tried, bad = tried + 1, bad + (kind == "error")
            streak = streak + 1 if kind == "error" else 0
            reason = "consecutive_failures" if streak >= 4 else "failure_rate" if tried >= 25 and bad >= 0.4 * tried else None
            want.append((c, event, kind, reason))
            if reason:
                break
    got = sorted(map(tuple, spark.read.schema(P.PASSED).parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(want) and {w[3] for w in want} == {None, "consecutive_failures", "failure_rate"}


def test_a_page_is_handed_in_once_and_a_failed_batch_leaves_no_double(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from vidsift.streaming.callback import each_page
    from vidsift.streaming.replay import drain

    landed, folder = f"{tmp_path}/landed", f"{tmp_path}/out"
    schema = "search string, page int, items array<int>"
    calls, failing = [], {"on": False}

    def on_page(new):
        calls.append(sorted(r.page for r in new.collect()))
        return new.selectExpr("search", "page", "explode(items) AS item")

    def ledger(batch):
        if failing["on"]:
            raise RuntimeError("lost between the rows and the ledger")

    def feed(pages, twice=()):
        spark.createDataFrame([("s", p, [p, p + 1]) for p in [*pages, *twice]], schema).coalesce(1).write.mode("append").parquet(landed)

    def begin():
        return each_page(spark.readStream.schema(schema).parquet(landed), on_page, ["search", "page"], folder, ledger)

    feed([1, 2], twice=[2])
    drain(spark, begin)
    feed([2, 3, 4])
    failing["on"] = True
    with pytest.raises(StreamingQueryException):
        drain(spark, begin)
    failing["on"] = False
    drain(spark, begin)  # the same batch again
    feed([4, 1, 5])
    drain(spark, begin)
    assert calls == [[1, 2], [3, 4], [3, 4], [5]]
    rows = spark.read.parquet(f"{folder}/rows").select("page", "item").collect()
    assert sorted(map(tuple, rows)) == sorted((p, p + i) for p in range(1, 6) for i in (0, 1))


def test_many_units_take_one_call_and_one_state_value():
    import pandas as pd

    from vidsift.streaming import progress as P

    class Value:
        held, reads = None, 0

        def get(self):
            self.reads += 1
            return self.held

        def update(self, now):
            self.held = now

    value = Value()
    handle = type("Handle", (), {"getValueState": lambda self, *_: value})()
    p = P.Progress()
    p.init(handle)
    rows = log(random.Random(4), 50, 500)
    for part in (rows[:250], rows[250:]):
        x = pd.DataFrame(part, columns=["unit", "at", "event_id", "kind", "detail"])
        made = pd.concat(p.handleInputRows((3,), iter([x]), None))
        assert sorted(made["unit"]) == sorted(set(x["unit"]))
    last = {r.unit: r for r in made.itertuples()}
    for u in last:
        status, cursor, pages, error, skipped = machine([r[1:] for r in rows if r[0] == u])
        assert (last[u].status, last[u].pages, last[u].error, last[u].skipped) == (status, pages, error, skipped)
    assert value.reads == 2
