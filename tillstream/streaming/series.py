"""Metric samples as streams: counter rates and alerts with state per series.

Samples may come out of order within the watermark. A series keeps those the watermark hasn't passed yet,
and an event-time timer wakes it when it does; then they are taken in order, so results are those of the
batch operators on all closed samples, whatever the portions were. Samples behind the watermark are
dropped by Spark and counted in its progress.

State per series: the samples not yet closed, and for a rate those of one trailing window, for an alert
four numbers. It is in the state store, so a restart goes on where the last micro-batch was committed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillstream import constants as C

_BUFFER = "at array<bigint>, seq array<bigint>, value array<double>"


class _InOrder(StatefulProcessor):
    """Holds samples back until the watermark has passed them, then hands them on in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getValueState("buffer", _BUFFER)
        self.kept = handle.getValueState("kept", self.kept_schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f[["at", "seq", "value"]] for f in rows]
        return self._advance(key, frames, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._advance(key, [], timerValues)

    def _advance(self, key, frames: list[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        held = self.buffer.get() if self.buffer.exists() else ([], [], [])
        at = np.concatenate([np.array(held[0], np.int64), *(f["at"].to_numpy(np.int64) for f in frames)])
        seq = np.concatenate([np.array(held[1], np.int64), *(f["seq"].to_numpy(np.int64) for f in frames)])
        value = np.concatenate([np.array(held[2], float), *(f["value"].to_numpy(float) for f in frames)])
        order = np.lexsort((seq, at))
        at, seq, value = at[order], seq[order], value[order]
        closed = int(np.searchsorted(at, timers.getCurrentWatermarkInMs() * 1000, "right"))
        self.buffer.update((at[closed:].tolist(), seq[closed:].tolist(), value[closed:].tolist()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if closed < len(at):
            self.handle.registerTimer(-(-int(at[closed]) // 1000))
        if closed:
            kept = self.kept.get() if self.kept.exists() else None
            kept, out = self.take(kept, at[:closed], seq[:closed], value[:closed])
            self.kept.update(kept)
            if len(out):
                for name, part in zip(self.names, key, strict=True):
                    out[name] = part
                yield out

    def close(self) -> None:
        pass


class _Rates(_InOrder):
    """Trailing samples with the counter's growth up to them."""

    kept_schema = "at array<bigint>, grown array<double>, value double"

    def __init__(self, names: list[str], seconds: int):
        self.names, self.length = names, seconds * 1_000_000

    def take(self, kept, at, seq, value):
        before, grown, last = ([], [], None) if kept is None else kept
        steps = np.empty(len(value))
        earlier = np.concatenate([[value[0] if last is None else last], value[:-1]])
        np.subtract(value, earlier, out=steps)
        # A fall is a reset: the new value counts.
        steps[value < earlier] = value[value < earlier]
        total = (grown[-1] if len(grown) else 0.0) + np.cumsum(steps)
        all_at = np.concatenate([np.array(before, np.int64), at])
        all_grown = np.concatenate([np.array(grown, float), total])
        first = np.searchsorted(all_at, at - self.length)
        peers = np.searchsorted(all_at, at, "right") - 1
        increase = all_grown[peers] - all_grown[first]
        elapsed = (at - all_at[first]) / 1e6
        rate = pd.array(np.divide(increase, elapsed, out=np.zeros(len(at)), where=elapsed > 0))
        rate[elapsed <= 0] = pd.NA
        out = pd.DataFrame({"at": at, "seq": seq, "increase": increase, "rate": rate})
        stays = int(np.searchsorted(all_at, at[-1] - self.length))
        return (all_at[stays:].tolist(), all_grown[stays:].tolist(), float(value[-1])), out


class _Alert(_InOrder):
    """The stretch above the bound that the series is in: idle (none), pending, or firing."""

    kept_schema = "start bigint, end bigint, samples bigint"

    def __init__(self, names: list[str], bound: float, seconds: int):
        self.names, self.bound, self.shortest = names, bound, seconds * 1_000_000

    def take(self, kept, at, seq, value):
        start, end, samples = (None, None, 0) if kept is None else kept
        above, rows = value > self.bound, []
        # Stretches of equal state within these samples.
        turns = np.flatnonzero(np.diff(above)) + 1
        bounds = [0, *turns.tolist(), len(at)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            if above[low]:
                start = int(at[low]) if start is None else start
                end, samples = int(at[high - 1]), samples + high - low
                if end - start >= self.shortest:
                    rows.append(("firing", start, end, samples))
            elif start is not None:
                if end - start >= self.shortest:
                    rows.append(("resolved", start, end, samples))
                start, end, samples = None, None, 0
        return (start, end, samples), pd.DataFrame(
            rows, columns=["state", "start", "end", "samples"])


def _stateful(samples: DataFrame, series: Sequence[str] | str, processor: type[_InOrder], columns: str,
              late: str, ts: str, value: str, seq: str | None, *arguments) -> DataFrame:
    by = [series] if isinstance(series, str) else list(series)
    fields = {f.name: f.dataType for f in samples.schema.fields}
    rows = samples.select(
        *by, F.col(ts).alias("ts"), F.unix_micros(F.col(ts)).alias("at"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("seq"),
        F.col(value).cast("double").alias("value")).withWatermark("ts", late)
    out = T._parse_datatype_string(columns)
    for name in by:
        out = out.add(name, fields[name])
    return rows.groupBy(*by).transformWithStateInPandas(
        processor(by, *arguments), out, "Append", "EventTime")


def stream_counter_rate(samples: DataFrame, series: Sequence[str] | str, window_seconds: int,
                        late: str = C.OUT_OF_ORDERNESS, ts: str = "ts", value: str = "value",
                        seq: str | None = None) -> DataFrame:
    """`operators.metrics.counter_rate` of a stream: the series, ts, seq, increase and rate of each sample
    that the watermark has passed."""
    rated = _stateful(samples, series, _Rates, "at bigint, seq bigint, increase double, rate double",
                      late, ts, value, seq, window_seconds)
    kind = samples.schema[value].dataType
    return rated.withColumns({"ts": F.timestamp_micros("at"), "increase": F.col("increase").cast(kind)}
                             ).drop("at")


def stream_alert(samples: DataFrame, series: Sequence[str] | str, rule: tuple[float, int],
                 late: str = C.OUT_OF_ORDERNESS, ts: str = "ts", value: str = "value",
                 seq: str | None = None) -> DataFrame:
    """Log of an alert: the series, state (firing or resolved), start, end and samples of its stretch.

    A stretch that lasts long enough gives a row for each micro-batch that goes on with it, and one when
    it is over. `alert_stretches` folds the log.
    """
    log = _stateful(samples, series, _Alert, "state string, start bigint, end bigint, samples bigint",
                    late, ts, value, seq, *rule)
    return log.withColumns({c: F.timestamp_micros(c) for c in ("start", "end")})


def alert_stretches(log: DataFrame, series: Sequence[str] | str) -> DataFrame:
    """What `operators.metrics.sustained_breaches` gives, from an alert's log; `firing` tells whether the
    stretch goes on. A repeated micro-batch changes nothing."""
    by = [series] if isinstance(series, str) else list(series)
    newest = log.groupBy(*by, "start").agg(
        F.max(F.struct("samples", "end", F.col("state").alias("state"))).alias("newest"))
    lasted: Column = (F.unix_micros("breach_end") - F.unix_micros("breach_start")) / 1_000_000
    return newest.select(
        *by, F.col("start").alias("breach_start"), F.col("newest.end").alias("breach_end"),
        "newest.samples", (F.col("newest.state") == "firing").alias("firing")
    ).withColumn("duration_seconds", lasted)
