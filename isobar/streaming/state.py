"""Operators with keyed state of their own: nearest matches, running scores and running totals, each with an end to its state.

State lies in RocksDB (as transformWithState needs), a key at a time; a restart from a checkpoint goes on where it ended.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from statistics import median

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators.learning import HISTORY

PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE = 60_000_000


def on_rocksdb(spark: SparkSession) -> None:
    """Streams that this session starts from now on hold their state in RocksDB, unless another store than the default is set."""
    if "HDFSBackedStateStoreProvider" in spark.conf.get(PROVIDER, "HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)


class _Nearest(StatefulProcessor):
    """State of a key: times of observations (with the least id of each) and forecasts that wait for the watermark."""

    def __init__(self, names: list[str], width: int, ids: tuple[str, str]) -> None:
        self.row, self.width, self.ids = Row(*names), width, ids

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.observed = handle.getMapState("observed", "at bigint", f"id {self.ids[1]}")
        self.waiting = handle.getMapState("waiting", f"at bigint, id {self.ids[0]}", "n int")

    def _wake(self, at: int) -> None:
        """A timer at the first whole minute from which on the watermark is past at (microseconds)."""
        self.handle.registerTimer((at // MINUTE + 1) * 60_000)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        past = timerValues.getCurrentWatermarkInMs() * 1000
        for r in rows:
            at = r["_us"]
            if at < past:
                continue  # later than the watermark lets it be, whatever batch it came in
            if r["_forecast"]:
                held = self.waiting.getValue((at, r["_f"])) if self.waiting.containsKey((at, r["_f"])) else (0,)
                self.waiting.updateValue((at, r["_f"]), (held[0] + 1,))
                self._wake(at + self.width)
            else:
                known = self.observed.getValue((at,))[0] if self.observed.containsKey((at,)) else r["_o"]
                self.observed.updateValue((at,), (min(known, r["_o"]),))
                self._wake(at + 2 * self.width)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        past = timerValues.getCurrentWatermarkInMs() * 1000
        ready = sorted((tuple(k), n[0]) for k, n in self.waiting.iterator() if k[0] + self.width < past)
        known = sorted((k[0], v[0]) for k, v in self.observed.iterator())
        times, out = [t for t, _ in known], []
        for (at, number), n in ready:
            i = bisect_left(times, at)
            near = [(abs(t - at), o, t) for t, o in known[max(i - 1, 0) : i + 1] if abs(t - at) <= self.width]
            if near:
                gap, o, t = min(near)
                out += [self.row(*key, number, at, o, t, gap / 1e6)] * n
            self.waiting.removeKey((at, number))
        for t in times:
            if t + 2 * self.width < past:  # forecasts still to come or waiting are later than that
                self.observed.removeKey((t,))
        return iter(out)

    def close(self) -> None:
        pass


def nearest_matches(forecasts: DataFrame, observations: DataFrame, on: list[str], forecast_time: str, observed_time: str, forecast_id: str, observed_id: str, minutes: int = 90, late: str = "90 minutes") -> DataFrame:
    """on, forecast_id, forecast_time, observed_id, observed_time and gap (seconds): each forecast of a stream with the nearest
    observation of the other stream with the same keys, within minutes; of equals the least observed_id. The same rows as
    learning.nearest_in_time gives for all rows that weren't late.

    A forecast waits until the watermark (late behind the latest row of either stream) has passed every observation that it
    could take; then it leaves with its match, or without a row. A key's state holds the observations of twice minutes and
    the forecasts of minutes before the watermark, and what came after it. Rows with a null key, time or id are left out;
    output mode append.
    """
    on_rocksdb(forecasts.sparkSession)
    kinds = dict(forecasts.dtypes)[forecast_id], dict(observations.dtypes)[observed_id]
    none = lambda k: F.lit(None).cast(k)
    f = forecasts.select(*on, F.col(forecast_time).cast("timestamp").alias("_at"), F.lit(True).alias("_forecast"), F.col(forecast_id).alias("_f"), none(kinds[1]).alias("_o"))
    o = observations.select(*on, F.col(observed_time).cast("timestamp").alias("_at"), F.lit(False).alias("_forecast"), none(kinds[0]).alias("_f"), F.col(observed_id).alias("_o"))
    both = f.unionByName(o).filter("_at is not null and coalesce(_f is not null, false) = _forecast and (_forecast or _o is not null)").dropna(subset=on)
    both = both.withWatermark("_at", late).withColumn("_us", F.unix_micros("_at"))
    types = dict(forecasts.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in on], f"`{forecast_id}` {kinds[0]}, _fa bigint, `{observed_id}` {kinds[1]}, _oa bigint, gap double"])
    found = both.groupBy(*on).transformWithState(_Nearest([*on, forecast_id, "_fa", observed_id, "_oa", "gap"], minutes * MINUTE, kinds), schema, "append", "eventTime")
    return found.select(*on, forecast_id, F.timestamp_micros("_fa").alias(forecast_time), observed_id, F.timestamp_micros("_oa").alias(observed_time), "gap")


class _Scores(StatefulProcessor):
    """State of a group: an entry a provider, which ends when the watermark is `width` past its latest error."""

    def __init__(self, names: list[str], alpha: float, width: int) -> None:
        self.row, self.alpha, self.width = Row(*names), alpha, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("scores", "provider string", "score double, sample_count bigint, history array<double>, at bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        new: dict[str, list] = {}
        for r in rows:
            if r["_error"] is not None and math.isfinite(r["_error"]):
                new.setdefault(r["_provider"], []).append((r["_order"], r["_error"], r["_us"]))
        for provider, found in new.items():
            errors, at = [e for _, e, _ in sorted(found)], max(t for _, _, t in found)
            score, count, history, before = self.held.getValue((provider,)) if self.held.containsKey((provider,)) else (1.0, 0, [], at)
            score = self.alpha * (math.fsum(errors) / len(errors)) + (1 - self.alpha) * score
            self.held.updateValue((provider,), (score, count + len(errors), [*history, *errors][-HISTORY:], max(at, before)))
            self.handle.registerTimer((max(at, before) + self.width) // MINUTE * 60_000 + 60_000)
        if not new:
            return iter(())
        all_ = [(k[0], *v) for k, v in self.held.iterator()]
        skill = [max(math.exp(-(0.5 * score + 0.5 * median(history))), 0.01) for _, score, _, history, _ in all_]
        share = [max(s / sum(skill), 0.02) for s in skill]
        return iter([self.row(*key, provider, score, count, list(history), s / sum(share)) for (provider, score, count, history, _), s in zip(all_, share, strict=True)])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        past = timerValues.getCurrentWatermarkInMs() * 1000
        for provider in [k[0] for k, v in self.held.iterator() if v[3] + self.width < past]:
            self.held.removeKey((provider,))
        return iter(())

    def close(self) -> None:
        pass


def running_scores(errors: DataFrame, by: list[str], provider: str, error: str, order: str, at: str, alpha: float = 0.15, days: float = 30, late: str = "1 day") -> DataFrame:
    """by, provider, score, sample_count, history and weight of a stream of errors, as learning.updated_scores gives them batch
    by batch: a group's providers again whenever it has new errors (output mode update).

    Each provider's entry is written by itself and no other group is read. An entry ends when the watermark (late behind the
    latest time `at`) is days past its latest error; weights are shares of those left. Rows with a null key, provider or time
    are left out, and errors that are null or not finite.
    """
    on_rocksdb(errors.sparkSession)
    types = dict(errors.dtypes)
    rows = errors.select(*by, F.col(provider).cast("string").alias("_provider"), F.col(error).cast("double").alias("_error"), F.coalesce(F.col(order).cast("string"), F.lit("")).alias("_order"), F.col(at).cast("timestamp").alias("_at"))
    rows = rows.dropna(subset=[*by, "_provider", "_at"]).withWatermark("_at", late).withColumn("_us", F.unix_micros("_at"))
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in by], f"`{provider}` string, score double, sample_count bigint, history array<double>, weight double"])
    names = [*by, provider, "score", "sample_count", "history", "weight"]
    return rows.groupBy(*by).transformWithState(_Scores(names, alpha, int(days * 1440) * MINUTE), schema, "update", "eventTime")


class _Amounts(StatefulProcessor):
    """State of a cell: its last running total and when it was."""

    def __init__(self, width: int | None) -> None:
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last double, at bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        last, latest = self.last.get() if self.last.exists() else (None, 0)
        out = []
        for r in sorted(rows, key=lambda r: r["hour"]):
            value = r["value"]
            out.append(Row(cell=key[0], hour=r["hour"], amount=max(value - last, 0.0) if r["running"] and last is not None and value is not None else value))
            if r["running"] and value is not None:
                last, latest = value, max(latest, r["_us"])
        if last is not None:
            self.last.update((float(last), latest))
            if self.width is not None:
                self.handle.registerTimer((latest + self.width) // MINUTE * 60_000 + 60_000)
        return iter(out)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        if self.last.exists() and self.last.get()[1] + self.width < timerValues.getCurrentWatermarkInMs() * 1000:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def interval_amounts(stream: DataFrame, at: str | None = None, days: float = 16, late: str = "1 day") -> DataFrame:
    """cell, hour and amount of a stream of (cell, hour, value, running): running totals as amounts since the cell's last one.

    The state of a cell is its last running total; a batch's rows of a cell are taken by hour, and a cell's hours must come in
    order from batch to batch. With a time column `at`, a total ends when the watermark (late behind the latest time) is days
    past it; without one, a stream of ever new cells holds one number for each. Rows without an hour or cell are left out.
    """
    on_rocksdb(stream.sparkSession)
    rows = stream.filter("cell is not null and hour is not null")
    if at is not None:
        rows = rows.withColumn("_at", F.col(at).cast("timestamp")).filter("_at is not null").withWatermark("_at", late)
    time = F.lit(0).cast("long") if at is None else F.unix_micros("_at")
    rows = rows.select("cell", "hour", F.col("value").cast("double").alias("value"), F.coalesce("running", F.lit(False)).alias("running"), time.alias("_us"), *([] if at is None else ["_at"]))
    return rows.groupBy("cell").transformWithState(_Amounts(None if at is None else int(days * 1440) * MINUTE), "cell string, hour int, amount double", "append", "none" if at is None else "eventTime")
