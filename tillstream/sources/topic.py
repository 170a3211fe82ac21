"""Topic source: records with JSON text in `value`.

In production the format is `kafka`. The same code runs on a folder of text lines or of
parquet records, which is how it is tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, topic: str, *, fmt: str = "kafka", streaming: bool = True,
               max_per_trigger: int | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Column `value STRING` of one topic.

    `max_per_trigger` bounds a stream's micro-batches: records for `kafka`, else files.

    For `kafka`, `topic` is the topic name and `options` holds at least
    `kafka.bootstrap.servers`; a stream starts from its checkpoint, else from the earliest
    offset. For `text` and `parquet`, `topic` is the path of a folder.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_per_trigger is not None:
        reader = reader.option(
            "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", max_per_trigger)
    if fmt == "kafka":
        reader = reader.format("kafka").option("subscribe", topic).option(
            "startingOffsets", "earliest")
        frame = reader.options(**(options or {})).load()
        return frame.select(F.col("value").cast("string").alias("value"))
    if fmt not in ("text", "parquet"):
        raise ValueError(f"unknown topic format {fmt!r}")
    schema = "value STRING" if fmt == "text" else "key STRING, value STRING"
    frame = reader.format(fmt).schema(schema).options(**(options or {})).load(topic)
    return frame.select("value")
