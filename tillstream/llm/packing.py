"""Packing without crossing documents: each document is cut into pieces of binary length.

A document of n tokens becomes as many pieces of the longest length as fit, and for the rest one
piece for each set bit of the rest, longest first. A piece is a sequence of its own: its length
is a power of two, so nothing is padded, and sequences of equal length form one bucket.

There is no shuffle: a row's pieces come from that row alone.

Null or empty text: one piece that holds the end token alone. Very long texts are cut like any other.
Repeated rows: each is cut by itself. Empty table: no rows. Null doc_id: null in its pieces. Other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices
from tillstream.llm.words import encode, word_ids

MAX_TOKENS = 4096
END_ID = 2

_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
           "ids array<int>, sequence_id bigint, offset bigint")


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two that sum to `tokens`: `longest` as often as it fits, then the bits of the rest."""
    rest = tokens % longest
    bits = [1 << bit for bit in range(longest.bit_length() - 2, -1, -1) if rest >> bit & 1]
    return [longest] * (tokens // longest) + bits


def pack(documents: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset.

    `max_tokens` is a power of two. `ids` is null if not `with_ids`. Sequence ids are unique, and
    those of one bucket lie together: the bucket's number is above the row's.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            docs, starts, lengths, sums, totals, parts = [], [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch),
                                    strict=True):
                ids = encode(known, text) + end
                total, start = len(ids) // 4, 0
                for length in binary_lengths(total, max_tokens):
                    docs.append(doc_id)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(ids[4 * start:4 * (start + length)]))
                    totals.append(total)
                    start += length
                parts.append(ids)
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                ids_column = pa.ListArray.from_arrays(pa.array(ends), flat)
            else:
                ids_column = pa.nulls(len(docs), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(totals, pa.int64()), ids_column],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    pieces = arrow_map(documents.select(F.col("doc_id").cast("bigint"), "text"), cut,
                       _SCHEMA.partition(", sequence_id")[0])
    # Bits of the number: bucket above, then partition and row within it (below 2**57).
    bucket = F.log2(F.col("length")).cast("bigint")
    return pieces.withColumns({
        "sequence_id": F.shiftleft(bucket, 57) + F.monotonically_increasing_id(),
        "offset": F.lit(0).cast("bigint"),
    })
