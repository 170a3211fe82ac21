"""A ranking that is kept up to date while its windows are open.

The totals of a window leave the aggregation in update mode, those that changed in a micro-batch. They are
logged; the windows they belong to are ranked again from the newest total of each key; and what that
changes in the first ranks is logged as rows taken back and rows put in. Both logs have a folder per
micro-batch, written as a whole, so a micro-batch that runs again replaces its own rows and sees only
those of earlier ones.

Nothing is ranked or written in one task: totals are folded and cut to the first ranks as in batch, and
changes are written by window. Only windows that changed are read, by their dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tillstream import constants as C
from tillstream.operators.rank import top_n_per_window
from tillstream.schemas import TOTAL
from tillstream.streaming.jobs import windowed_totals

BATCH = "batch"
RETRACT, INSERT = -1, 1


def _totals_schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
        T.StructField(key, T.StringType()), T.StructField("total_sales", TOTAL),
        T.StructField("transaction_count", T.LongType())])


def changes_schema(key: str) -> T.StructType:
    """Rows of the change log: a ranked row, taken back or put in."""
    return (_totals_schema(key).add("rank", T.IntegerType()).add("change", T.IntegerType())
            .add(BATCH, T.LongType()))


def _log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ranking_changes(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The change log at `path`."""
    return _log(spark, f"{path}/changes", changes_schema(key))


def folded(changes: DataFrame) -> DataFrame:
    """The ranking that a change log amounts to: rows put in as often as taken back cancel out."""
    row = [c for c in changes.columns if c not in ("change", BATCH)]
    left = changes.groupBy(*row).agg(F.sum("change").alias("left"))
    return left.where("left > 0").drop("left")


def running_ranking_job(sales: DataFrame, key: str, path: str, checkpoint: str, *, n: int = C.TOP_N,
                        length: str = C.WINDOW_LENGTH, out_of_order: str = C.OUT_OF_ORDERNESS,
                        country: str | None = None) -> DataStreamWriter:
    """Keep the first n ranks of every open window, as a log of changes at `path`/changes."""
    totals = windowed_totals(sales, key, length, out_of_order, country)
    return (totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(_rank_changes(key, path, n)))


def _rank_changes(key: str, path: str, n: int) -> Callable[[DataFrame, int], None]:
    total_columns = _totals_schema(key).names
    ranked_columns = [*total_columns, "rank"]

    def rank_changes(totals: DataFrame, batch_id: int) -> None:
        spark = totals.sparkSession
        own = f"{BATCH}={batch_id}"
        (totals.select(*total_columns[:-2], F.col("total_sales").cast(TOTAL), "transaction_count")
         .write.mode("overwrite").parquet(f"{path}/totals/{own}"))
        log = _log(spark, f"{path}/totals", _totals_schema(key).add(BATCH, T.LongType()))
        changed = log.where(F.col(BATCH) == batch_id).select("window_start").distinct()
        bounds = changed.agg(F.min("window_start"), F.max("window_start")).first()
        if bounds[0] is None:
            return
        of_changed = F.col("window_start").between(*map(F.lit, bounds))
        # A later total of a key covers all of an earlier one.
        newest = (log.where(of_changed & (F.col(BATCH) <= batch_id))
                  .join(changed, "window_start", "left_semi")
                  .groupBy("window_start", "window_end", key)
                  .agg(F.max(F.struct(BATCH, "total_sales", "transaction_count")).alias("newest"))
                  .select("window_start", "window_end", key, "newest.total_sales",
                          "newest.transaction_count"))
        now = top_n_per_window(newest, key, n).select(*ranked_columns)
        earlier = ranking_changes(spark, path, key).where(of_changed & (F.col(BATCH) < batch_id))
        before = folded(earlier.join(changed, "window_start", "left_semi"))
        # Dealt by window: a file for each task that has one, and 2 n rows of a window at most.
        both = now.withColumn("change", F.lit(INSERT)).unionByName(
            before.withColumn("change", F.lit(RETRACT))).repartition("window_start")
        # What is the same before and after is no change.
        moved = both.groupBy(*ranked_columns).agg(F.sum("change").cast("int").alias("change"))
        moved.where("change != 0").write.mode("overwrite").parquet(f"{path}/changes/{own}")

    return rank_changes
