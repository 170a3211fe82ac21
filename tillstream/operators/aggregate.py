"""Windowed totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.schemas import TOTAL


def _totals(amount: Column, count: Column) -> list[Column]:
    return [
        F.sum(amount).cast(TOTAL).alias("total_sales"),
        count.cast("bigint").alias("transaction_count"),
    ]


def sales_by_window(sales: DataFrame, key: str, length: str = C.WINDOW_LENGTH,
                    event_time: str = "event_time", amount: str = "amount") -> DataFrame:
    """Sum and count per tumbling window and key, batch or streaming.

    One shuffle on (window, key), after partial sums on the map side: a key that holds a
    third of all rows reaches its reducer as one row per map task and window.
    """
    return (
        sales
        .groupBy(F.window(event_time, length).alias("w"), F.col(key))
        .agg(*_totals(F.col(amount), F.count(F.lit(1))))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            key, "total_sales", "transaction_count",
        )
    )


def merge_partials(partials: DataFrame, key: str) -> DataFrame:
    """Add up partial totals of the same window and key."""
    return (
        partials
        .groupBy("window_start", "window_end", key)
        .agg(*_totals(F.col("total_sales"), F.sum("transaction_count")))
    )
