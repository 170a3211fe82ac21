"""Ranking tables: parquet, partitioned by the date of the window.

A window has few rows, so a partition per window would leave one tiny file and one folder to
list for every window ever ranked. A partition per date keeps both small.

Everything appends: nothing written is ever touched again, and versions are told apart on reading.
`compact_rankings` writes a folded log as a new table, to be swapped in by its path.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import TOTAL

PARTITION = "window_date"


def ranking_rows(ranked: DataFrame, updated_at: Column | None = None,
                 batch_id: int = 0) -> DataFrame:
    """Ranked totals in the column types of the result table, with their version."""
    names = [c for c in ("city", "salesman_name", "country") if c in ranked.columns]
    return ranked.select(
        "window_start", "window_end", *names,
        F.col("total_sales").cast(TOTAL).alias("total_sales"),
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        F.col("rank").cast("int").alias("rank"),
        F.date_trunc("second", F.current_timestamp() if updated_at is None else updated_at)
        .alias("updated_at"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.to_date("window_start").alias(PARTITION),
    )


def append_rankings(rows: DataFrame, path: str) -> None:
    """Append a version of some windows to a log, to be read through `latest_by_key`."""
    # One file per date, not one per task and date.
    rows.repartition(PARTITION).write.mode("append").partitionBy(PARTITION).parquet(path)


def replace_rankings(rows: DataFrame, path: str) -> None:
    """Restate the windows present in `rows` as a whole; all other windows stay.

    The rows are appended, in one commit, as a version above all others of their dates; reads
    through `serve.latest_windows` see either the old rows or the new ones. Only the versions of
    those dates are read, and their maximum is all that passes through the driver.
    """
    table = _existing(rows.sparkSession, path, rows.schema)
    if table is None:
        append_rankings(rows, path)
        return
    # Rankings are few rows; they are worked out once, for their dates and for the write.
    rows = rows.persist()
    try:
        newest = table.join(rows.select(PARTITION).distinct(), PARTITION, "left_semi").agg(
            F.max("updated_at").alias("updated_at"), F.max("batch_id").alias("batch_id")).first()
        above = rows
        if newest["updated_at"] is not None:
            above = rows.withColumns({
                "updated_at": F.greatest("updated_at", F.lit(newest["updated_at"])),
                "batch_id": F.lit(newest["batch_id"] + 1).cast("bigint")})
        append_rankings(above, path)
    finally:
        rows.unpersist()


def append_once(rows: DataFrame, path: str) -> None:
    """Append a micro-batch's windows, but for those that the table has from a micro-batch of this number.

    A job that fails between its write and its commit runs the micro-batch again. Its windows leave the
    aggregation once, so what stands in the table under its number is what it wrote; a write is committed
    as a whole or not at all. For a table with one writer and one checkpoint.
    """
    table = _existing(rows.sparkSession, path, rows.schema)
    if table is None:
        append_rankings(rows, path)
        return
    rows = rows.persist()
    try:
        written = (table.join(rows.select(PARTITION).distinct(), PARTITION, "left_semi")
                   .select("window_start", "batch_id").distinct())
        append_rankings(rows.join(written, ["window_start", "batch_id"], "left_anti")
                        .select(*rows.columns), path)
    finally:
        rows.unpersist()


def compact_rankings(log: DataFrame, path: str) -> None:
    """Write what reads see of a ranking log (already folded) as a new table, one file per date."""
    log.repartition(PARTITION).write.partitionBy(PARTITION).parquet(path)


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return read_rankings(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_rankings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a ranking table with its declared types, partition column included."""
    return spark.read.schema(schema).parquet(path)
