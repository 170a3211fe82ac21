"""Near-duplicates by SimHash, linked through a grid over per-segment bit counts.

A fingerprint is embedded as the bit counts of its 32 segments of two bits. The Manhattan distance
of two embeddings is never above the Hamming distance of the fingerprints. At a distance of 3 or
less over all segments, one half of them is at 1 or less. So each half has a grid with a cell for
every vector of counts; a fingerprint goes to its own cell and to those one step up in a single
segment, and any two within reach meet in a cell of one half. What meets is verified exactly.

Only distinct fingerprints go to the grid, so copies cost nothing there. A cell's fingerprints
give a spanning forest of its links, not all pairs. A cell with many of them is dealt to
tasks by pairs of parts, so that no task gets more than two parts.

Null text counts as empty, very long texts are hashed whole. A text without words has fingerprint zero and links like any other.
Rows that repeat a doc_id each get a row. A null doc_id counts for no component id unless there is
none other. Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import (
    arrow_map,
    as_bytes,
    dealt_by_parts,
    slices,
    stored,
    text_key,
    whole_groups,
)
from tillstream.llm.graph import roots

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
CELL_PART = 2048

_EVEN_BITS = 0x5555555555555555
_TASK = ["half", "cell", "first_part", "second_part"]


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Bit by bit the majority of the shingles' XXH64, repeats included."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), HASH_SEED)]
    else:
        # Shingles are slices of the words joined by one space.
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], HASH_SEED) for i, j in zip(
            starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)]
    votes = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for start in range(0, len(values), 1 << 16):
        part = values[start:start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, print) of every row; print is the fingerprint as a signed number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = np.array([simhash(text, words) for text in as_bytes(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"),
                 pa.array(prints.view(np.int64))], ["doc_id", "text_key", "print"])

    rows = documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
    return arrow_map(rows, hashed, "doc_id bigint, text_key bigint, print bigint")


def segment_counts(bits: Column) -> Column:
    """Bit counts of the 32 segments of 64 bits, two bits each, in one number."""
    upper = F.shiftrightunsigned(bits, 1)
    return F.shiftleft(upper.bitwiseAND(bits).bitwiseAND(F.lit(_EVEN_BITS)), 1).bitwiseOR(
        upper.bitwiseXOR(bits).bitwiseAND(F.lit(_EVEN_BITS)))


def _cells(prints: DataFrame) -> DataFrame:
    """(half, cell, print): the cells a fingerprint goes to in the grids of both halves."""
    counts = segment_counts(F.col("print"))
    halves = F.array(F.struct(F.lit(0).alias("half"),
                              counts.bitwiseAND(F.lit(0xFFFFFFFF)).alias("cell")),
                     F.struct(F.lit(1).alias("half"),
                              F.shiftrightunsigned(counts, 32).alias("cell")))
    own = prints.select("print", F.explode(halves).alias("at")).select("print", "at.*")
    # A segment's count is 0, 1 or 2; a step up adds one to it.
    steps = F.expr("""concat(array(cell), transform(
        filter(sequence(0, 30, 2), i -> (shiftright(cell, i) & 3L) < 2L),
        i -> cell + shiftleft(1L, i)))""")
    return own.select("half", "print", F.explode(steps).alias("cell"))


def _forest(prints: np.ndarray, radius: int) -> tuple[list, list]:
    """Links that span what lies within `radius` among distinct fingerprints."""
    left, right = [], []
    rest = prints
    while len(rest) > 1:
        # Grow one tree: what is near a member joins and is not looked at again.
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            member = front.pop()
            near = np.bitwise_count(rest ^ member) <= radius
            if near.any():
                joined = rest[near]
                left.append(np.full(len(joined), member))
                right.append(joined)
                front.extend(joined)
                rest = rest[~near]
    return left, right


def _cell_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within cells; rows come sorted by cell."""
    for table, starts in whole_groups(batches, _TASK):
        prints = table.column("print").to_numpy().view(np.uint64)
        sizes = np.diff(starts, append=len(prints))
        two = starts[sizes == 2]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= radius
        left, right = [prints[two][near]], [prints[two + 1][near]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            a, b = _forest(prints[start:start + size], radius)
            left += a
            right += b
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.uint64).view(np.int64)) for x in (left, right)],
            ["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS, part: int = CELL_PART) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column print) within `radius`, 3 at most."""
    if not 0 <= radius <= 3:
        raise ValueError("the grid serves a radius of 0 to 3")
    cells = stored(_cells(prints.select("print").distinct()), "cells")
    dealt = dealt_by_parts(cells, ["half", "cell"], "print", part)
    sorted_cells = dealt.repartition(*_TASK).sortWithinPartitions(*_TASK)
    return arrow_map(sorted_cells, lambda batches: _cell_links(batches, radius),
                     "a bigint, b bigint")


def components(documents: DataFrame, words: int = SHINGLE_WORDS,
               radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, text_key, fingerprint (hex), component_id."""
    prints = stored(fingerprints(documents, words), "simhash")
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("first_doc"))
    root_of = roots(links(classes, radius)).withColumnRenamed("key", "print")
    classes = classes.join(root_of, "print", "left").select(
        "print", "first_doc", F.coalesce("root", "print").alias("root"))
    least = classes.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_print = classes.join(least, "root").select("print", "component_id")
    return prints.join(of_print, "print").select(
        "doc_id", "text_key",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
