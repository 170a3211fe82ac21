"""Batch form of the ranking pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.functions.times import format_window
from tillstream.operators.aggregate import sales_by_window
from tillstream.operators.normalize import filter_country
from tillstream.operators.rank import top_n_per_window


def top_cities(sales: DataFrame, n: int = C.TOP_N, length: str = C.WINDOW_LENGTH,
               salts: int = 1) -> DataFrame:
    """Top cities by total sales in each window."""
    return top_n_per_window(sales_by_window(sales, "city", length), "city", n, salts)


def top_salesmen(sales: DataFrame, country: str = C.RANKED_COUNTRY, n: int = C.TOP_N,
                 length: str = C.WINDOW_LENGTH) -> DataFrame:
    """Top salesmen of one country by total sales in each window.

    A salesman is a name; the output country is the one asked for, whatever its spelling in
    the input.
    """
    totals = sales_by_window(filter_country(sales, country), "salesman_name", length)
    return top_n_per_window(totals, "salesman_name", n).withColumn("country", F.lit(country))


def with_window_text(df: DataFrame) -> DataFrame:
    """Window bounds as text."""
    return df.withColumns({
        "window_start": format_window(F.col("window_start")),
        "window_end": format_window(F.col("window_end")),
    })
