"""Metric samples of running streams, for the operators on metrics.

A series is a name, with what tells its instances apart behind slashes:

- rows and times of a micro-batch, and rows dropped as late;
- `state_rows/<operator>` and `state_bytes/<operator>`: what a stateful operator holds;
- `source_lag/<source>/<topic>/<partition>`: how far the offsets that were read are behind the latest
  ones. A source that numbers its files or rows has one such series, without topic and partition;
- `observed/<name>/<counter>`: observed counters, such as those of data quality.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillstream.schemas import METRIC_SAMPLE


def _samples(progress: dict) -> list[tuple[datetime, str, float]]:
    at = datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
    values = {
        "input_rows": progress.get("numInputRows"),
        "input_rows_per_second": progress.get("inputRowsPerSecond"),
        "processed_rows_per_second": progress.get("processedRowsPerSecond"),
        "batch_ms": progress.get("durationMs", {}).get("triggerExecution"),
        "commit_ms": progress.get("durationMs", {}).get("commitOffsets"),
        "rows_dropped_late": sum(
            state.get("numRowsDroppedByWatermark", 0)
            for state in progress.get("stateOperators", [])),
    }
    for k, state in enumerate(progress.get("stateOperators", [])):
        values[f"state_rows/{k}"] = state.get("numRowsTotal")
        values[f"state_bytes/{k}"] = state.get("memoryUsedBytes")
    for k, source in enumerate(progress.get("sources", [])):
        read, latest = source.get("endOffset"), source.get("latestOffset")
        newest = dict(_numbers(latest if latest is not None else read))
        for place, offset in _numbers(read):
            values["/".join(["source_lag", str(k), *place])] = newest.get(place, offset) - offset
    for name, counters in progress.get("observedMetrics", {}).items():
        for counter, value in counters.items():
            if isinstance(value, (int, float)):
                values[f"observed/{name}/{counter}"] = value
    return [(at, name, float(value)) for name, value in values.items() if value is not None]


# What offsets of sources that have a single one call it.
_SINGLE = ("logOffset", "offset")


def _numbers(offset, place: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], float]]:
    """The numbers in an offset, by where they stand in it."""
    if isinstance(offset, dict):
        for name, inner in offset.items():
            yield from _numbers(inner, place if name in _SINGLE else (*place, name))
    elif isinstance(offset, (int, float)):
        yield place, offset


def progress_samples(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """`(ts, series, value)` of the micro-batches that Spark still keeps of a query (100 at most).

    A look at a query; `ProgressLog` records every micro-batch.
    """
    rows = [sample for progress in query.recentProgress
            for sample in _samples(json.loads(progress.json))]
    return spark.createDataFrame(rows, METRIC_SAMPLE)


class ProgressLog(StreamingQueryListener):
    """Appends the samples of every micro-batch of every query to a parquet folder.

    Give it to `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = _samples(json.loads(event.progress.json))
        (self.spark.createDataFrame(rows, METRIC_SAMPLE).coalesce(1)
         .write.mode("append").parquet(self.path))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
