"""Totals of windows that a ranking job hasn't closed yet, read from its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schemas import TOTAL


def open_totals(spark: SparkSession, checkpoint: str, key: str, batch_id: int | None = None) -> DataFrame:
    """(window_start, window_end, the key, total_sales, transaction_count) as of the last committed
    micro-batch of the ranking job at `checkpoint`, or of the one named.

    Reads the files of the state store, in as many tasks as it has partitions. The job may be running.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    window, name = state.schema["key"].dataType.names
    total, count = _buffers(state.schema["value"].dataType.names)
    at = F.col("key").getField(window)
    return state.select(
        at["start"].alias("window_start"), at["end"].alias("window_end"),
        F.col("key").getField(name).alias(key),
        F.col("value").getField(total).cast(TOTAL).alias("total_sales"),
        F.col("value").getField(count).cast("bigint").alias("transaction_count"))


def _buffers(names: list[str]) -> tuple[str, str]:
    """The buffers of the sum and the count; a sum of decimals has a second one, for being empty."""
    return (next(n for n in names if n.startswith("sum")),
            next(n for n in names if n.startswith("count")))
