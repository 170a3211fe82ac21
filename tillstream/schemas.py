"""Column types of the events, sources and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tillstream import constants as C

MONEY = T.DecimalType(18, 2)
# Holds the sum of 10**10 amounts of the largest size.
TOTAL = T.DecimalType(28, 2)

# --- Fixed values: field names and types of events, records, sources and results --

SALES_EVENT = T.StructType([
    T.StructField("sale_id", T.StringType()),
    T.StructField("salesman_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("product", T.StringType()),
    T.StructField("event_time_ms", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingestion_time_ms", T.LongType()),
])

# The unified topic carries the same fields under camel-case names.
UNIFIED_RECORD = T.StructType([
    T.StructField("saleId", T.StringType()),
    T.StructField("salesmanName", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("product", T.StringType()),
    T.StructField("eventTime", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingestionTime", T.LongType()),
])

RELATIONAL_SALE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("salesman_id", T.LongType()),
    T.StructField("salesman", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("product", T.StringType()),
    T.StructField("sale_date", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])

CSV_SALE = T.StructType([
    T.StructField(name, T.StringType()) for name in C.CSV_COLUMNS
])

LEGACY_SALE = T.StructType([
    T.StructField("saleId", T.StringType()),
    T.StructField("salesmanName", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("product", T.StringType()),
    T.StructField("saleDate", T.LongType()),
])

RELATIONAL_MARK = T.StructType([
    T.StructField("offset_value", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("producer_id", T.StringType()),
    T.StructField("version", T.LongType()),
])


def ranking(key: str, with_country: bool = False) -> T.StructType:
    """Result table of one ranking; `window_date` is its partition column."""
    country = [T.StructField("country", T.StringType())] if with_country else []
    return T.StructType([
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField(key, T.StringType()),
        *country,
        T.StructField("total_sales", TOTAL),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("window_date", T.DateType()),
    ])


CITY_RANKING = ranking("city")
SALESMAN_RANKING = ranking("salesman_name", with_country=True)

METRIC_SAMPLE = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("series", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
