"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import run_dir

_PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])

# Text handed to numpy or Python at once. A longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """`mapInArrow` whose workers can import this package also where it is not installed."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _PACKAGE_ROOT)
    return df.mapInArrow(function, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As `stored`, with the folder, for those that remove it when nothing reads it any more."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def text_of(column: str | Column = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(column: str | Column = "text") -> Column:
    """With doc_id, what tells rows apart that share a doc_id."""
    return F.xxhash64(text_of(column))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `most` bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def dealt_by_parts(rows: DataFrame, keys: list[str], value: str, part: int) -> DataFrame:
    """Rows of (keys, value) for tasks that compare the values of a key with each other.

    Adds `mine`, `first_part` and `second_part`. A key of up to `part` values has one part. A larger one
    is dealt over parts by hash, and there is a task for every two of them and each by itself, so no
    task gets more than two parts. Values of different parts meet once, in the task of those two.
    """
    full = (rows.groupBy(*keys).count().where(F.col("count") > part)
            .select(*keys, F.ceil(F.col("count") / part).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64(value), parts).cast("int")
    return (rows.join(full, keys, "left")
            .select(*keys, value, mine.alias("mine"),
                    F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
            .select(*keys, value, "mine", F.least("mine", "other").alias("first_part"),
                    F.greatest("mine", "other").alias("second_part")))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                 rows: int = 1 << 18) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about so many rows with the places where their groups start; rows come sorted by
    the keys (whole numbers), and no group is cut."""
    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for key in keys:
            column = table.column(key).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = bounds(table)
            # The last group may go on in the next batch.
            if starts[-1]:
                yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
            held = table.slice(starts[-1]).to_batches()
    if sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, bounds(table)
