"""CSV sales files: a header row, plain commas, no quoting, every value a trimmed string.

In both readers a value missing at the end of a line is NULL and an empty one is ''.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream import constants as C
from tillstream.schemas import CSV_SALE

# A plan has a branch for every header.
LAYOUTS = 32

# No text has it, so a line stays whole.
_NEVER = "\x01"
# What trimming takes off: control characters and the blank.
_TRIMMED = "".join(map(chr, range(0x21)))


def _lines(spark: SparkSession, column: str, streaming: bool,
           options: dict[str, str] | None):
    reader = spark.readStream if streaming else spark.read
    return (
        reader.schema(T.StructType([T.StructField(column, T.StringType())]))
        .options(sep=_NEVER, quote="", recursiveFileLookup=True, pathGlobFilter="*.csv")
        .options(**(options or {}))
    )


def read_csv_sales(spark: SparkSession, path: str, *, streaming: bool = False,
                   options: dict[str, str] | None = None) -> DataFrame:
    """All `.csv` files below a folder, for files in the usual column order.

    A stream takes each file once; its checkpoint remembers which, and commits a file as a
    whole. Columns are bound by position, so the headers are checked: a file with another header
    fails the read. `read_csv_sales_by_name` reads such files. Large files are split.
    """
    header = ",".join(C.CSV_COLUMNS)
    lines = _lines(spark, header, streaming, options).options(
        header=True, enforceSchema=False).csv(path)
    cells = lines.select(F.split(F.col(f"`{header}`"), ",", -1).alias("cells"),
                         F.col(f"`{header}`").alias("line"))
    return cells.where(~F.col("line").rlike(r"^\s*\z")).select(
        *[_trimmed(F.get("cells", F.lit(i))).alias(name) for i, name in enumerate(C.CSV_COLUMNS)])


def read_csv_sales_by_name(spark: SparkSession, path: str, *, streaming: bool = False,
                           options: dict[str, str] | None = None) -> DataFrame:
    """The same files with columns bound by each file's own header, in any order, batch or stream.

    Blank lines are skipped, extra values are ignored; of repeated names the last that has a value
    counts.

    In batch, the headers are read first; files of one header are read together by position, and large
    files are split. A stream learns of its files as they come: there, and with more than `LAYOUTS` headers, a
    file is read by one task, in order (`multiLine` keeps it whole), so its first line is at hand for
    all that follow. Neither way has a shuffle of lines.
    """
    layouts = {} if streaming else _layouts(spark, path, options)
    if not 0 < len(layouts) <= LAYOUTS:
        lines = (_lines(spark, "value", streaming, options).option("multiLine", True).csv(path)
                 .select("value", F.col("_metadata.file_path").alias("file")))
        return lines.mapInArrow(_bind, CSV_SALE)
    parts = []
    for header, files in layouts.items():
        lines = _lines(spark, "value", False, options).options(header=True).csv(files)
        cells = lines.where(~F.col("value").rlike(r"^\s*\z")).select(
            F.split("value", ",", -1).alias("cells"))
        names = [name.strip(_TRIMMED) for name in header.split(",")]
        parts.append(cells.select(*[_named(names, column).alias(column) for column in C.CSV_COLUMNS]))
    return reduce(DataFrame.unionByName, parts)


def _layouts(spark: SparkSession, path: str, options: dict[str, str] | None) -> dict[str, list[str]]:
    """Files by their first line. The driver gets a row per file, as the listing of the folder has."""
    lines = _lines(spark, "value", False, options).csv(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start")
    # Lines of a block come in order, and the first block has the header.
    first = (lines.where("file_block_start = 0").withColumn("place", F.monotonically_increasing_id())
             .groupBy("file_path").agg(F.min_by("value", "place").alias("header")))
    found: dict[str, list[str]] = {}
    for row in first.collect():
        found.setdefault(row["header"], []).append(unquote(row["file_path"]))
    return found


def _named(names: list[str], column: str) -> Column:
    """The last value under a name."""
    places = [k for k in range(len(names) - 1, -1, -1) if names[k] == column]
    return F.coalesce(F.lit(None).cast("string"),
                      *(_trimmed(F.get("cells", F.lit(k))) for k in places))


def retired_to(archive: str) -> dict[str, str]:
    """Options of a streaming read: files go to `archive` once the micro-batch that took them has been
    committed. A file whose micro-batch fails stays where it is and is taken again as a whole."""
    return {"cleanSource": "archive", "sourceArchiveDir": archive}


def _bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    file, names = None, []
    for batch in batches:
        columns: dict[str, list[str | None]] = {name: [] for name in CSV_SALE.names}
        for line, path in zip(batch.column("value").to_pylist(), batch.column("file").to_pylist(),
                              strict=True):
            if path != file:
                file, names = path, [name.strip(_TRIMMED) for name in (line or "").split(",")]
            elif line and not line.isspace():
                row = {name: cell.strip(_TRIMMED)
                       for name, cell in zip(names, line.split(","), strict=False)}
                for name, cells in columns.items():
                    cells.append(row.get(name))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.string()) for cells in columns.values()], list(columns))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")
