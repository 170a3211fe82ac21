"""Token counts of documents in flat token files that have no index.

A file is a run of fixed-width unsigned numbers; a document ends with a separator. Files come as
blocks (file, block, data), cut anywhere between two numbers. Every block is searched for separators
in one vectorized comparison. Where a document's start lies in an earlier block, it follows from a
prefix scan over blocks of the tokens before each block and of the last separator up to there. The
scan has two levels, spans of `SPAN` blocks and blocks within a span, so that a file of any
length is scanned by many tasks.

Tokens behind a file's last separator are a document without end (`ended` false). A block without data
counts for nothing. Empty table: no rows. A null file is a file of its own. The writer takes a null text
as empty: a document of no tokens, which only its separator shows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import arrow_map, as_bytes, slices
from tillstream.llm.words import encode, word_ids

BLOCK_TOKENS = 1 << 16
SPAN = 1024

BLOCKS = "file bigint, block bigint, data binary"


def search(blocks: DataFrame, separator: int, width: int = 2) -> DataFrame:
    """(file, block, tokens, ends): number of tokens and places of the separators of each block.

    `width` is the bytes of a number, 2 or 4, little-endian.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            blocks = [np.frombuffer(d, kind) for d in as_bytes(batch, "data")]
            ends = [np.flatnonzero(b == separator).astype(np.int32) for b in blocks]
            cuts = np.cumsum([0, *map(len, ends)]).astype(np.int32)
            flat = np.concatenate(ends) if ends else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"),
                 pa.array([len(b) for b in blocks], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))],
                ["file", "block", "tokens", "ends"])

    return arrow_map(blocks.select("file", "block", "data"), searched,
                     "file bigint, block bigint, tokens bigint, ends array<int>")


def _scanned(found: DataFrame) -> DataFrame:
    """Adds `base` (tokens of the file before the block), `open` (start of the document that
    reaches into it) and `documents` (separators before it)."""
    span = F.floor(F.col("block") / SPAN)
    light = found.select("file", "block", span.alias("span"), "tokens",
                         F.size("ends").cast("bigint").alias("stops"),
                         F.try_element_at("ends", F.lit(-1)).alias("last"))
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    light = light.select(
        "file", "block", "span", "tokens", "stops", "last",
        F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("base"),
        F.coalesce(F.sum("stops").over(inside), F.lit(0)).alias("documents"))
    # First token behind the last separator, counted from the span's start.
    light = light.withColumn("behind", F.col("base") + F.col("last") + 1)
    light = light.withColumn("open", F.max("behind").over(inside))
    spans = light.groupBy("file", "span").agg(
        F.sum("tokens").alias("span_tokens"), F.sum("stops").alias("span_stops"),
        F.max("behind").alias("span_behind"))
    outside = Window.partitionBy("file").orderBy("span").rowsBetween(
        Window.unboundedPreceding, -1)
    spans = spans.withColumn("span_base", F.coalesce(F.sum("span_tokens").over(outside), F.lit(0)))
    spans = spans.select(
        "file", "span", "span_base",
        F.coalesce(F.sum("span_stops").over(outside), F.lit(0)).alias("span_documents"),
        F.coalesce(F.max(F.col("span_base") + F.col("span_behind")).over(outside), F.lit(0))
        .alias("span_open"))
    same = (F.col("b.file").eqNullSafe(F.col("s.file"))) & (F.col("b.span") == F.col("s.span"))
    return light.alias("b").join(spans.alias("s"), same).select(
        F.col("b.file"), "block", (F.col("span_base") + F.col("base")).alias("base"),
        F.coalesce(F.col("span_base") + F.col("open"), "span_open").alias("open"),
        (F.col("span_documents") + F.col("documents")).alias("documents"))


def count_tokens(found: DataFrame) -> DataFrame:
    """One row per document of the files that `search` went through: file, ordinal (from 0),
    start, n_tokens (without the separator), ended, block (in which it ends), place (its end
    among the block's ends)."""
    places = _scanned(found)
    same = F.col("f.file").eqNullSafe(F.col("p.file")) & (F.col("f.block") == F.col("p.block"))
    both = found.alias("f").join(places.alias("p"), same).select(
        F.col("f.file"), F.col("f.block"), "tokens", "ends", "base", "open", "documents")
    stops = both.select("file", "block", "base", "open", "documents", "ends",
                        F.posexplode("ends").alias("place", "end"))
    start = F.when(F.col("place") == 0, F.col("open")).otherwise(
        F.col("base") + F.get("ends", F.col("place") - 1) + 1)
    ended = stops.select(
        "file", (F.col("documents") + F.col("place")).alias("ordinal"), start.alias("start"),
        (F.col("base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"),
        "block", "place")
    behind = both.select(
        "file", F.size("ends").alias("stops"), "documents",
        (F.col("base") + F.col("tokens")).alias("total"),
        F.coalesce(F.col("base") + F.try_element_at("ends", F.lit(-1)) + 1, "open").alias("start"))
    rest = (behind.groupBy("file").agg(
        F.max(F.col("documents") + F.col("stops")).alias("ordinal"), F.max("start").alias("start"),
        F.max("total").alias("total")).where("total > start")
        .select("file", "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"),
                F.lit(False).alias("ended"), F.lit(None).cast("bigint").alias("block"),
                F.lit(None).cast("int").alias("place")))
    return ended.unionByName(rest)


def write_blocks(documents: DataFrame, tokenizer_path: str, separator: int,
                 block_tokens: int = BLOCK_TOKENS, width: int = 2) -> DataFrame:
    """Documents as flat files of ids of `width` bytes, one file for each partition, in blocks. An id that
    needs more bytes is an error.

    Besides (file, block, data) a row has `doc_ids`, the documents that end in the block: a
    listing kept apart from the files, for whoever wants to name what the scan finds. Strings of
    special tokens in a text are ordinary text, so the separator only ends documents.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, file = word_ids(tokenizer_path, as_text=True), TaskContext.get().partitionId()
        kind, most = {2: "<u2", 4: "<u4"}[width], 1 << 8 * width
        end, size = np.array([separator], kind), width * block_tokens
        held, listed, block = b"", [], 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch),
                                    strict=True):
                ids = np.frombuffer(encode(known, text), "<u4")
                if len(ids) and ids.max() >= most:
                    raise ValueError(f"id {ids.max()} doesn't fit {width} bytes")
                held += ids.astype(kind).tobytes()
                start = 0
                while len(held) - start >= size:
                    yield _block(file, block, held[start:start + size], listed)
                    start, listed, block = start + size, [], block + 1
                held = held[start:] + end.tobytes()
                listed.append(doc_id)
                if len(held) == size:
                    yield _block(file, block, held, listed)
                    held, listed, block = b"", [], block + 1
        if held:
            yield _block(file, block, held, listed)

    return arrow_map(documents.select(F.col("doc_id").cast("bigint"), "text"), written,
                     f"{BLOCKS}, doc_ids array<bigint>")


def _block(file: int, block: int, data: bytes, doc_ids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary()),
         pa.array([doc_ids], pa.list_(pa.int64()))], ["file", "block", "data", "doc_ids"])
