"""The given `events` table as sales, and as records in the shape of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import iso_local
from tillstream.schemas import MONEY
from tillstream.sinks.topic import to_topic_records
from tillstream.sources.legacy import legacy_records
from tillstream.sources.relational import relational_records

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = (
        spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def as_sales(events: DataFrame) -> DataFrame:
    """Events as sales, with BR spelled in two ways among four countries."""
    kind = F.pmod("event_id", F.lit(4))
    return events.select(
        "event_id", "user_id",
        F.concat(F.lit("E"), F.col("event_id")).alias("sale_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("salesman_name"),
        F.concat(F.lit("city_"), F.pmod("event_id", F.lit(25))).alias("city"),
        F.when(kind == 0, "BR").when(kind == 1, "br").when(kind == 2, "AR").otherwise("US")
        .alias("country"),
        F.col("value").cast(MONEY).alias("amount"),
        F.col("event_type").alias("product"),
        F.col("ts").alias("event_time"),
    )


def read_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_sales(read_events(spark, sf_dir))


def relational_rows(sales: DataFrame) -> DataFrame:
    """Sales in the columns of the relational table; its keys start at 1."""
    return sales.select(
        (F.col("event_id") + 1).alias("id"),
        F.col("user_id").alias("salesman_id"),
        F.col("salesman_name").alias("salesman"),
        "city", "country", F.col("amount").cast("decimal(12,2)").alias("amount"), "product",
        F.col("event_time").alias("sale_date"),
        F.col("event_time").alias("created_at"),
    )


def csv_rows(sales: DataFrame) -> DataFrame:
    """Sales in the columns of the CSV files, all text."""
    return sales.select(
        "sale_id", "salesman_name", "city", "country",
        F.col("amount").cast("string").alias("amount"), "product",
        iso_local(F.col("event_time")).alias("sale_date"),
    )


def legacy_rows(sales: DataFrame) -> DataFrame:
    """Sales in the columns of the legacy responses."""
    return sales.select(
        F.col("sale_id").alias("saleId"),
        F.col("salesman_name").alias("salesmanName"),
        "city", "country", F.col("amount").cast("double").alias("amount"), "product",
        F.unix_millis("event_time").alias("saleDate"),
    )


def source_records(sales: DataFrame, source: str) -> DataFrame:
    """Sales as the `key, value` records of one source topic."""
    rows = {
        "postgres": lambda: relational_records(relational_rows(sales)),
        "files": lambda: csv_rows(sales),
        "legacy": lambda: legacy_records(legacy_rows(sales)),
    }[source]()
    return to_topic_records(rows)
