"""Legacy sales: landed XML responses, one `sales` element per sale."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.schemas import LEGACY_SALE
from tillstream.session import remove, run_dir
from tillstream.sources.relational import load_mark, save_mark

ROW_TAG = "sales"
# How far the clock of a file may be behind the clock of the sales in it.
CLOCK_SLACK_MS = 60 * 60 * 1000


def read_legacy_sales(spark: SparkSession, path: str, since_ms: int | None = None, *,
                      streaming: bool = False) -> DataFrame:
    """Sales of all landed responses, optionally only those after a time in ms.

    A response can't hold sales later than it landed, so a batch read with a time leaves out files that
    were written before it, less `CLOCK_SLACK_MS`.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("xml").schema(LEGACY_SALE).option("rowTag", ROW_TAG)
    if since_ms is not None and not streaming:
        landed = datetime.fromtimestamp(max(0, since_ms - CLOCK_SLACK_MS) // 1000, timezone.utc)
        reader = reader.options(modifiedAfter=landed.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC")
    sales = reader.load(path)
    return sales if since_ms is None else sales.where(F.col("saleDate") > since_ms)


def legacy_records(sales: DataFrame) -> DataFrame:
    """JSON-ready columns of a legacy sale."""
    return sales.select(*LEGACY_SALE.names, F.lit("legacy").alias("source"))


def poll_legacy(spark: SparkSession, path: str, marks: str, send: Callable[[DataFrame], None],
                now_ms: int, producer: str = C.LEGACY_PRODUCER) -> int:
    """Send the sales after the saved time, then set it to `now_ms`. Returns the time.

    Without a saved time the last five minutes are sent. The time moves only if there were sales and
    `send` has returned for all of them.
    """
    since = load_mark(spark, marks, producer, now_ms - C.LEGACY_LOOKBACK_MS)
    # Responses are parsed once, for the question whether there is anything and for sending it.
    landed = run_dir(spark, "legacy-poll")
    try:
        legacy_records(read_legacy_sales(spark, path, since)).write.parquet(landed)
        sales = spark.read.parquet(landed)
        if sales.isEmpty():
            return since
        send(sales)
    finally:
        remove(spark, landed)
    save_mark(spark, marks, now_ms, producer)
    return now_ms
