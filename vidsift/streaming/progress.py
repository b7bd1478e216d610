"""Keyed state of a collection: resumable progress of its units, and the breaker that stops a failing collector."""

from __future__ import annotations

import json
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

PROGRESS = "unit string, status string, cursor long, pages long, error string, skipped long, version long"
PASSED = "collector long, event_id long, kind string, stop_reason string"


def _in_order(rows, by: list[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch; a source with maxFilesPerTrigger bounds them."""
    return pd.concat(list(rows), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


class Progress(StatefulProcessor):
    """Status and cursor of a unit, moved by its pages: `page`, `last` (no more to come) or `error`.

    An error before any page fails the unit, a later one leaves it partial, to be resumed behind its cursor; the last page
    completes it. Pages of completed and failed units are counted as skipped and change nothing else. Units share lanes: a
    call and a state value cost far more than a unit's few rows, so a lane's units are moved in one call, and kept as one text.
    """

    def init(self, handle) -> None:
        self.state = handle.getValueState("lane", "units string")

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        units = {u: now for u, *now in json.loads(held[0])} if held else {}
        x = _in_order(rows, ["at", "event_id"])
        kinds, details, events, made = x["kind"].tolist(), x["detail"].tolist(), x["event_id"].tolist(), []
        mine = defaultdict(list)
        for i, unit in enumerate(x["unit"].tolist()):
            mine[unit].append(i)
        for unit, at in mine.items():
            now = _moved(units.get(unit) or ["running", None, 0, None, 0, 0], [(kinds[i], details[i], events[i]) for i in at])
            units[unit] = now
            made.append((unit, *now))
        self.state.update((json.dumps([(u, *now) for u, now in units.items()]),))
        yield pd.DataFrame(made, columns=["unit", "status", "cursor", "pages", "error", "skipped", "version"]).astype({"cursor": "Int64"})


def _moved(state: list, rows: list[tuple[str, str, int]]) -> list:
    """The state of one unit behind some more (kind, detail, event) in order."""
    status, cursor, pages, error, skipped, version = state
    for kind, detail, event in rows:
        if status in ("completed", "failed"):
            skipped += 1
        elif kind == "error":
            status, error = ("partial" if pages else "failed"), detail
        else:
            pages, cursor = pages + 1, int(event)
            if kind == "last":
                status, error = "completed", None
    return [status, cursor, pages, error, skipped, version + 1]


class Breaker(StatefulProcessor):
    """Passes a collector's results on, the one that stops it included, and nothing of it afterwards."""

    def __init__(self, in_a_row: int, least: int, rate: float):
        self.limit, self.least, self.rate = in_a_row, least, rate

    def init(self, handle) -> None:
        self.state = handle.getValueState("collector", "attempts long, failures long, in_a_row long, stopped boolean")

    def handleInputRows(self, key, rows, timerValues):
        attempts, failures, in_a_row, stopped = self.state.get() or (0, 0, 0, False)
        if stopped:
            return
        x = _in_order(rows, ["at", "event_id"])
        bad = (x["kind"] == "error").to_numpy()
        place = np.arange(1, len(x) + 1)
        good_at = np.maximum.accumulate(np.where(bad, 0, place))
        runs = np.where(good_at == 0, in_a_row + place, place - good_at)
        tried, failed = attempts + place, failures + np.cumsum(bad)
        by_run, by_rate = bad & (runs >= self.limit), (tried >= self.least) & (failed >= self.rate * tried)
        stops = np.flatnonzero(by_run | by_rate)
        n = int(stops[0]) + 1 if len(stops) else len(x)
        self.state.update((int(tried[n - 1]), int(failed[n - 1]), int(runs[n - 1]), bool(len(stops))))
        reason = [None] * n
        if len(stops):
            reason[-1] = "consecutive_failures" if by_run[n - 1] else "failure_rate"
        yield pd.DataFrame({"collector": key[0], "event_id": x["event_id"].to_numpy()[:n], "kind": x["kind"].to_numpy()[:n], "stop_reason": pd.Series(reason, dtype="object")})


def _kept(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    made = stream.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "None")
    return made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def follow(stream: DataFrame, out: str, checkpoint: str, lanes: int = 512) -> StreamingQuery:
    """Append a unit's state to ``out`` whenever it changed; stream: (unit, at, event_id, kind, detail). ``lanes`` must stay
    the same for all starts on one checkpoint."""
    lane = F.pmod(F.xxhash64("unit"), F.lit(lanes)).alias("lane")
    return _kept(stream.select(lane, "unit", "at", "event_id", "kind", "detail"), "lane", Progress(), PROGRESS, out, checkpoint)


def current(states: DataFrame) -> DataFrame:
    """The newest state of each unit."""
    fields = [c for c in states.columns if c not in ("unit", "version")]
    newest = states.groupBy("unit").agg(F.max_by(F.struct(*fields), "version").alias("s"))
    return newest.select("unit", *[F.col(f"s.{c}").alias(c) for c in fields])


def resume(units: DataFrame, states: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Units that are to be queried, with the cursor to go on from: null for new ones and for failed ones tried again."""
    settled = F.col("status").isin("completed", *([] if retry_failed else ["failed"]))
    return units.join(current(states).select("unit", "status", "cursor"), "unit", "left").where(~F.coalesce(settled, F.lit(False)))


def guard(stream: DataFrame, out: str, checkpoint: str, in_a_row: int = 8, least: int = 20, rate: float = 0.25) -> StreamingQuery:
    """Append to ``out`` what collectors may pass on; stream: (collector, at, event_id, kind).

    A collector stops at its ``in_a_row``-th failure without a success between, or once ``least`` attempts have failed
    at ``rate`` or above.
    """
    return _kept(stream.select("collector", "at", "event_id", "kind"), "collector", Breaker(in_a_row, least, rate), PASSED, out, checkpoint)
