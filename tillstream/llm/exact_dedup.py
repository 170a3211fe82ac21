"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every block of documents (a run within one partition) sorts the distinct fingerprints of its
   normalized texts, cuts them by owner (a range of fingerprints) and sends each owner one
   Rice-coded message.
2. An owner decodes its messages, finds the fingerprints that came from more than one block, and
   answers each block with a bitmap over its own sorted fingerprints.
3. Documents whose bit is set, or whose block had the fingerprint twice, are suspects. Their texts
   alone, partly aggregated, are shuffled by their bytes and compared byte by byte. Up to
   `BROADCAST_SUSPECTS` of them are told by a broadcast of their names; beyond, all texts are shuffled
   once to fetch theirs.

Texts are equal when identical after deleting ASCII white space. Of equal texts the one with most
code points stays, then the smallest doc_id.

Null text counts as empty; all empty texts are equal. Very long texts are compared whole. Rows that repeat a doc_id with equal text
count each in group_size and share its decision. A null doc_id loses to any other; if no other is
there, the row keeps itself (keep_id null). Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices, stored, text_key

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
FINGERPRINT_BITS = 56
BLOCK_DOCUMENTS = 1 << 20
# So many names of suspects, 16 bytes each, are sent to all executors at most.
BROADCAST_SUSPECTS = 1_000_000

# Rank of a row is code points x step - doc_id; a null doc_id counts as one behind all.
_STEP = 10**20
_BEHIND_ALL = 10**19

_BLOCKS = ("doc_id bigint, text_key bigint, n_chars bigint, text_sha256 string, twice boolean, "
           "block string, owner int, position int, message binary")


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct numbers as Rice-coded gaps: count, parameter, unary part, remainders."""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    low = max(0, int(np.log2(max(1.0, float(values[-1]) / len(values)))))
    tops = (gaps >> np.uint64(low)).astype(np.int64)
    ends = np.cumsum(tops + 1) - 1
    unary = np.ones(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 0
    shifts = np.arange(low, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(values), low, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(remainders.ravel()).tobytes()


def rice_decode(message: bytes) -> np.ndarray:
    """The numbers of `rice_encode`."""
    count, low, unary_bits = (int(x) for x in np.frombuffer(message[:12], "<u4"))
    cut = 12 + (unary_bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(message[12:cut], np.uint8), count=unary_bits)
    ends = np.flatnonzero(unary == 0)
    tops = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(message[cut:], np.uint8), count=count * low)
    weights = np.uint64(1) << np.arange(low, dtype=np.uint64)
    remainders = (bits.reshape(count, low) * weights).sum(axis=1, dtype=np.uint64)
    return np.cumsum((tops << np.uint64(low)) + remainders, dtype=np.uint64)


def _send(documents: DataFrame, owners: int) -> DataFrame:
    """One row per document with its place in its block; the first row to an owner has the message."""
    width = -(-(1 << FINGERPRINT_BITS) // owners)

    def block_rows(name: str, rows: list[tuple], prints: list[int]) -> pa.RecordBatch:
        values = np.array(prints, np.uint64)
        distinct, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        owner = (distinct // np.uint64(width)).astype(np.int64)
        first = np.searchsorted(owner, owner)
        positions = np.arange(len(distinct)) - first
        messages: list[bytes | None] = [None] * len(rows)
        row_of = np.full(len(distinct), -1)
        row_of[inverse[::-1]] = np.arange(len(rows))[::-1]
        for start in np.unique(first):
            stop = int(np.searchsorted(owner, owner[start], "right"))
            base = np.uint64(int(owner[start]) * width)
            messages[row_of[start]] = rice_encode(distinct[start:stop] - base)
        doc_ids, keys, chars, hashes = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(keys, pa.int64()),
             pa.array(chars, pa.int64()), pa.array(hashes), pa.array(counts[inverse] > 1),
             pa.array([name] * len(rows)), pa.array(owner[inverse].astype(np.int32)),
             pa.array(positions[inverse].astype(np.int32)), pa.array(messages, pa.binary())],
            ["doc_id", "text_key", "n_chars", "text_sha256", "twice", "block", "owner",
             "position", "message"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, prints, name = [], [], ""
        for batch in slices(batches):
            for doc_id, key, chars, place, text in zip(
                    *(batch.column(c).to_pylist()
                      for c in ("doc_id", "text_key", "n_chars", "place")),
                    as_bytes(batch), strict=True):
                name = name or str(place)
                bare = text.translate(None, WHITE_SPACE)
                rows.append((doc_id, key, chars, hashlib.sha256(bare).hexdigest()))
                prints.append(xxhash.xxh64_intdigest(bare) >> (64 - FINGERPRINT_BITS))
                if len(rows) == BLOCK_DOCUMENTS:
                    yield block_rows(name, rows, prints)
                    rows, prints, name = [], [], ""
        if rows:
            yield block_rows(name, rows, prints)

    # `place` of a block's first row names the block.
    numbered = documents.select(
        F.col("doc_id").cast("bigint"), text_key().alias("text_key"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
        F.monotonically_increasing_id().alias("place"), "text")
    return arrow_map(numbered, send, _BLOCKS)


def _answer(messages: DataFrame) -> DataFrame:
    """Per block and owner a bitmap, 64 positions a number, of fingerprints that other blocks have too."""

    def answer(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        prints = [rice_decode(m) for m in table.column("message").to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(prints), return_inverse=True,
                                       return_counts=True)
        shared, ends = counts[inverse] > 1, np.cumsum([len(p) for p in prints])
        bitmaps = []
        for bits in np.split(shared, ends[:-1]):
            padded = np.zeros(-(-len(bits) // 64) * 64, np.uint8)
            padded[:len(bits)] = bits
            bitmaps.append(np.packbits(padded, bitorder="little").view("<i8").tolist())
        return pa.table({"block": pa.array(blocks), "owner": table.column("owner"),
                         "bitmap": pa.array(bitmaps, pa.list_(pa.int64()))})

    return messages.groupBy("owner").applyInArrow(
        answer, "block string, owner int, bitmap array<bigint>")


def deduplicate(documents: DataFrame, owners: int | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    `owners` is the number of fingerprint ranges, the session's shuffle partitions by default.
    """
    spark = documents.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    light = stored(_send(documents, owners), "exact-dedup")
    messages = light.where("message is not null").select("block", "owner", "message")
    marked = light.drop("message").join(_answer(messages), ["block", "owner"])
    shared = F.getbit(F.get("bitmap", F.floor(F.col("position") / 64).cast("int")),
                      F.col("position") % 64) == 1
    marked = marked.select("doc_id", "text_key", "n_chars", "text_sha256",
                           (F.col("twice") | shared).alias("suspect"))
    marked = stored(marked, "exact-dedup-marked")

    unique = marked.where("not suspect").select(
        "doc_id", "text_key", F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")

    suspects = marked.where("suspect")
    wanted = suspects.select("doc_id", "text_key").distinct()
    # Few suspects go to where the texts are; beyond the bound texts and suspects meet by a shuffle.
    if suspects.count() <= BROADCAST_SUSPECTS:
        wanted = F.broadcast(wanted)
    texts = documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
    named = F.col("texts.doc_id").eqNullSafe(F.col("wanted.doc_id"))
    texts = (texts.alias("texts")
             .join(wanted.alias("wanted"),
                   named & (F.col("texts.text_key") == F.col("wanted.text_key")), "left_semi")
             .select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars"),
                     F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
                     .alias("bare")))
    # More code points first, then the smaller doc_id: one number that a partial maximum can hold.
    # A null doc_id sorts behind all others.
    rank = F.expr(f"cast(n_chars as decimal(10, 0)) * {_STEP}BD"
                  f" - coalesce(cast(doc_id as decimal(19, 0)), {_BEHIND_ALL}BD)")
    groups = texts.groupBy("bare").agg(F.max(rank).alias("best"), F.count("*").alias("group_size"))
    keep = F.expr(f"{_STEP // 2}BD - (best + {_STEP // 2}BD) % {_STEP}BD")
    groups = groups.select(
        F.sha2("bare", 256).alias("text_sha256"), "group_size",
        F.when(keep < F.expr(f"{_BEHIND_ALL}BD"), keep.cast("bigint")).alias("keep_id"))
    copies = (suspects.join(groups, "text_sha256")
              .select("doc_id", "text_key", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
    return unique.unionByName(copies)
