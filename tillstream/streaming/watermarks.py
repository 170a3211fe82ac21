"""A watermark per source, and the release of one that has gone quiet.

With one watermark over the union, the source that is ahead closes windows for all others. Here each source
has its own, and the smallest one counts, so a source that lags holds windows open. A source that stays quiet
would hold them for ever; it gets a heartbeat instead: a record without a sale that carries the time up to
which the others have come. Heartbeats are files beside the topic, so a restarted job reads the same ones.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import constants as C

IDLE_SECONDS = 60
_BEAT = "source STRING, event_time TIMESTAMP"
_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def with_source_watermarks(sources: Mapping[str, DataFrame], out_of_order: str = C.OUT_OF_ORDERNESS,
                           heartbeats: str | None = None) -> DataFrame:
    """The union of event streams (`event_time` and equal other columns), each with its own watermark.

    `heartbeats` is the folder that `beat` writes to.
    """
    spark = next(iter(sources.values())).sparkSession
    if spark.conf.get(_POLICY, "min") != "min":
        raise ValueError(f"{_POLICY} has to be min")
    marked = []
    for source, events in sources.items():
        rows = events.withColumn("is_sale", F.lit(True))
        if heartbeats is not None:
            rows = rows.unionByName(_beats(spark, heartbeats, source), allowMissingColumns=True)
        # Heartbeats pass the watermark, then they go; observing keeps the filter from moving below it.
        rows = rows.withWatermark("event_time", out_of_order).observe(
            f"arrived_{source}", F.count_if("is_sale").alias("rows"),
            F.max(F.when(F.col("is_sale"), F.col("event_time"))).alias("newest"))
        marked.append(rows.where("is_sale").drop("is_sale"))
    return reduce(DataFrame.unionByName, marked)


def _beats(spark: SparkSession, heartbeats: str, source: str) -> DataFrame:
    beats = spark.readStream.schema(_BEAT).json(f"{heartbeats}/{source}")
    return beats.select("event_time", F.lit(False).alias("is_sale"))


def prepare_heartbeats(spark: SparkSession, heartbeats: str, sources: list[str]) -> None:
    """Folders for the heartbeats of these sources; a stream needs them to be there."""
    for source in sources:
        spark.createDataFrame([], _BEAT).write.mode("append").json(f"{heartbeats}/{source}")


def beat(spark: SparkSession, heartbeats: str, source: str, event_time: datetime | str) -> None:
    """Let a quiet source's watermark come up to `event_time` (less the out-of-order bound)."""
    (spark.createDataFrame([(source, str(event_time))], "source STRING, event_time STRING")
     .withColumn("event_time", F.to_timestamp("event_time")).coalesce(1)
     .write.mode("append").json(f"{heartbeats}/{source}"))


class IdleSources:
    """Watches a running query and beats for sources without a row for `idle_seconds`.

    Call `look` now and then, as often as the query triggers; it reads the observed counts of the query's
    progress. Only micro-batches that this object hasn't seen yet count.
    """

    def __init__(self, spark: SparkSession, heartbeats: str, sources: list[str],
                 idle_seconds: float = IDLE_SECONDS, clock=time.monotonic):
        self.spark, self.heartbeats, self.clock = spark, heartbeats, clock
        self.idle_seconds = idle_seconds
        self.heard = dict.fromkeys(sources, clock())
        self.newest: dict[str, str] = {}
        self.beaten: dict[str, str] = {}
        self.seen = -1

    def look(self, query: StreamingQuery) -> list[str]:
        """The sources that got a heartbeat just now."""
        for progress in query.recentProgress:
            self._take(json.loads(progress.json))
        ahead, now = max(self.newest.values(), default=None), self.clock()
        quiet = [s for s, at in self.heard.items() if ahead is not None
                 and now - at >= self.idle_seconds
                 and max(self.newest.get(s, ""), self.beaten.get(s, "")) < ahead]
        for source in quiet:
            beat(self.spark, self.heartbeats, source, ahead)
            self.beaten[source] = ahead
        return quiet

    def carry_over(self) -> None:
        """Before a restart: each source's own newest time as its heartbeat."""
        for source, newest in self.newest.items():
            beat(self.spark, self.heartbeats, source, max(newest, self.beaten.get(source, "")))

    def _take(self, progress: dict) -> None:
        if progress["batchId"] <= self.seen:
            return
        self.seen = progress["batchId"]
        for source in self.heard:
            row = progress.get("observedMetrics", {}).get(f"arrived_{source}", {})
            if row.get("rows"):
                self.heard[source] = self.clock()
                self.newest[source] = max(self.newest.get(source, ""), str(row["newest"]))
