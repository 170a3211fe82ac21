"""Topic sinks: JSON records, keyed per source or unkeyed on the unified topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tillstream import constants as C


def to_topic_records(rows: DataFrame) -> DataFrame:
    """`key, value` of a source topic: the row as JSON, keyed by its own id.

    NULL fields are written as JSON null.
    """
    ids = [F.col(name).cast("string") for name in C.RECORD_KEY_ALIASES if name in rows.columns]
    value = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(
        F.coalesce(*ids, F.lit(C.UNKNOWN_RECORD_KEY)).alias("key"), value.alias("value"))


def unified_records(events: DataFrame) -> DataFrame:
    """`value` of the unified topic, without a key."""
    record = F.struct(
        F.col("sale_id").alias("saleId"),
        F.col("salesman_name").alias("salesmanName"),
        "city", "country", "amount", "product",
        F.col("event_time_ms").alias("eventTime"),
        "source",
        F.col("ingestion_time_ms").alias("ingestionTime"),
    )
    return events.select(F.to_json(record).alias("value"))


def write_topic(records: DataFrame, topic: str, *, fmt: str = "kafka",
                options: dict[str, str] | None = None) -> None:
    """Append a batch of records; `text` takes the value only and drops the key."""
    writer = records.write.format(fmt).mode("append").options(**(options or {}))
    if fmt == "kafka":
        writer.option("topic", topic).save()
    else:
        writer.save(topic)


def stream_topic(records: DataFrame, topic: str, checkpoint: str, *, fmt: str = "kafka",
                 options: dict[str, str] | None = None) -> DataStreamWriter:
    """Writer of a stream of records; the caller sets the trigger and starts it."""
    writer = (
        records.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint).options(**(options or {}))
    )
    return writer.option("topic", topic) if fmt == "kafka" else writer.option("path", topic)
