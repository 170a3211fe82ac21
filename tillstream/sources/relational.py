"""Incremental scan of a relational sales table by high-water mark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.functions.times import iso_instant
from tillstream.schemas import RELATIONAL_MARK
from tillstream.session import remove


def scan_since(table: DataFrame, mark: int, key: str = "id",
               page: int | None = None) -> DataFrame:
    """All rows above the mark, in one partitioned job; with a `page`, the next so many by key.

    The filter reaches the scan, for files and for JDBC. A page is planned as a distributed top-k.
    """
    rows = table.where(F.col(key) > mark)
    return rows if page is None else rows.orderBy(key).limit(page)


def read_relational(spark: SparkSession, options: dict[str, str], *, mark: int = 0,
                    upper: int | None = None, partitions: int = 1) -> DataFrame:
    """JDBC scan of the `sales` table above a mark, split into key ranges read in parallel.

    `options` holds `url`, `dbtable`, the driver and the credentials. Splitting needs an upper
    key; it only sets the ranges, rows beyond it are read by the last one.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partitions > 1 and upper is not None:
        reader = reader.options(
            partitionColumn="id", lowerBound=str(mark), upperBound=str(upper),
            numPartitions=str(partitions))
    return reader.load().select(*C.RELATIONAL_COLUMNS).where(F.col("id") > mark)


def relational_records(rows: DataFrame) -> DataFrame:
    """JSON-ready columns: times as ISO instants, the rest as they are."""
    return rows.select(*[_json_ready(name) for name in C.RELATIONAL_COLUMNS])


def _json_ready(name: str) -> Column:
    if name in ("sale_date", "created_at"):
        return iso_instant(F.col(name)).alias(name)
    return F.col(name)


def load_mark(spark: SparkSession, path: str, producer: str = C.RELATIONAL_PRODUCER,
              default: int = 0) -> int:
    """Saved mark of one producer, `default` if there is none yet."""
    newest = _newest_mark(spark, path, producer)
    return default if newest is None else newest["offset_value"]


def _newest_mark(spark: SparkSession, path: str, producer: str) -> Row | None:
    try:
        marks = spark.read.schema(RELATIONAL_MARK).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (marks.where(F.col("producer_id") == producer)
            .orderBy(F.desc("version")).limit(1).first())


def save_mark(spark: SparkSession, path: str, mark: int,
              producer: str = C.RELATIONAL_PRODUCER) -> None:
    """Set the mark of one producer; the others keep theirs.

    A mark is a new version, added by one commit; the one before stays readable until it is there.
    Versions before that one are removed afterwards.
    """
    newest = _newest_mark(spark, path, producer)
    version = 1 if newest is None else newest["version"] + 1
    row = spark.range(1).select(
        F.lit(mark).cast("bigint").alias("offset_value"),
        F.current_timestamp().alias("updated_at"),
        F.lit(producer).alias("producer_id"), F.lit(version).cast("bigint").alias("version"),
    )
    row.write.mode("append").partitionBy("producer_id", "version").parquet(path)
    if version > 2:
        remove(spark, f"{path}/producer_id={producer}/version={version - 2}")


def advance_mark(rows: DataFrame, mark: int, key: str = "id") -> DataFrame:
    """New mark after these rows were sent: their highest key, never below the old mark."""
    return rows.agg(
        F.greatest(F.coalesce(F.max(key), F.lit(mark)), F.lit(mark)).cast("bigint")
        .alias("mark"))


def poll(spark: SparkSession, table: DataFrame, marks: str,
         send: Callable[[DataFrame], None], *, key: str = "id",
         producer: str = C.RELATIONAL_PRODUCER, page: int | None = None) -> int:
    """Send the rows above the saved mark, then move the mark. Returns the mark.

    What is sent ends at the highest key found before, so rows that come in meanwhile wait for
    the next poll. The mark moves only after `send` has returned. With a `page`, page after page
    is sent until nothing is left. With nothing new, `send` is not called.
    """
    mark = load_mark(spark, marks, producer)
    while True:
        highest = scan_since(table, mark, key, page).agg(F.max(key)).first()[0]
        if highest is None:
            return mark
        send(scan_since(table, mark, key).where(F.col(key) <= highest))
        mark = highest
        save_mark(spark, marks, mark, producer)
        if page is None:
            return mark
