"""Document fingerprints: SimHash over weighted terms, searched through permuted block tables.

Terms are pairs of neighbouring words, ASCII case folded (a text of one word has that word). A term
weighs 1 + log2 of how often it occurs. Its 128-bit hash votes with its weight for or against each bit of
the fingerprint.

Search: a fingerprint is cut into blocks. Two that differ in at most `radius` bits agree in all but
`radius` blocks, so there is a table for every choice of the blocks that agree, keyed by them;
what shares a key in any table is verified. Only distinct fingerprints enter the tables.

Null text counts as empty; a text without words has the zero fingerprint. Rows that repeat a
doc_id each get a row. Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
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

BITS = 128
RADIUS = 3
BLOCKS = 5
TABLE_PART = 2048

_TASK = ["table", "bucket", "first_part", "second_part"]

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.uint64(0xFF51AFD7ED558CCD)
_SECOND = np.uint64(0xC4CEB9FE1A85EC53)


class _WordHash(dict):
    """Word to its hash; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


@lru_cache(1)
def _word_hash() -> _WordHash:
    return _WordHash()


def _mixed(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * factor
    return values ^ (values >> np.uint64(29))


def simhash(text: bytes) -> bytes:
    """The fingerprint, 16 bytes."""
    words = text.lower().split()
    if not words:
        return bytes(BITS // 8)
    hashes = np.fromiter(map(_word_hash().__getitem__, words), np.uint64, len(words))
    if len(hashes) > 1:
        hashes = hashes[:-1] * _PAIR + ((hashes[1:] >> np.uint64(7)) ^ (hashes[1:] << np.uint64(23)))
    terms, times = np.unique(hashes, return_counts=True)
    weights = (1 + np.log2(times)).astype(np.float32)
    votes = np.zeros(BITS)
    for start in range(0, len(terms), 1 << 14):
        part = terms[start:start + (1 << 14)]
        spread = np.stack([_mixed(part, _FIRST), _mixed(_mixed(part, _SECOND), _FIRST)], axis=1)
        bits = np.unpackbits(spread.view(np.uint8), axis=1)
        votes += weights[start:start + (1 << 14)] @ bits.astype(np.float32)
    return np.packbits(2 * votes > float(weights.sum(dtype=np.float64))).tobytes()


def likeness(first: bytes, second: bytes) -> float:
    """Share of equal bits."""
    differing = int.from_bytes(first) ^ int.from_bytes(second)
    return 1 - differing.bit_count() / BITS


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([simhash(t).hex() for t in as_bytes(batch)], pa.string())],
                ["doc_id", "fingerprint"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_map(rows, hashed, "doc_id bigint, fingerprint string")


def _edges(blocks: int) -> list[int]:
    """Where blocks begin and end, in hex digits."""
    return [BITS // 4 * i // blocks for i in range(blocks + 1)]


def _tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fingerprint, table, key) for every choice of blocks - radius blocks."""
    if not 0 <= radius < blocks <= BITS // 4:
        raise ValueError("radius must be below the number of blocks")
    edges = _edges(blocks)
    block = [F.substring("fingerprint", edges[i] + 1, edges[i + 1] - edges[i])
             for i in range(blocks)]
    keys = [F.struct(F.lit(number).alias("table"), F.concat(*(block[i] for i in chosen)).alias("key"))
            for number, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    return (prints.select("fingerprint").distinct()
            .select("fingerprint", F.explode(F.array(*keys)).alias("at"))
            .select("fingerprint", "at.*"))


def _differing(first: str, second: str) -> F.Column:
    """Hamming distance of two fingerprint columns."""
    def part(column: str, start: int) -> F.Column:
        # 8 hex digits fit a number with room to spare.
        return F.conv(F.substring(column, start, 8), 16, 10).cast("bigint")
    return sum((F.bit_count(part(first, s).bitwiseXOR(part(second, s)))
                for s in range(1, BITS // 4, 8)), F.lit(0))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS,
                  blocks: int = BLOCKS) -> DataFrame:
    """Pairs (fingerprint, found, distance) of each distinct query fingerprint and all distinct
    ones within `radius` bits, the query's own value included where `prints` has it."""
    asked = _tables(queries, radius, blocks)
    there = _tables(prints, radius, blocks).withColumnRenamed("fingerprint", "found")
    return (asked.join(there, ["table", "key"])
            .withColumn("distance", _differing("fingerprint", "found").cast("int"))
            .where(F.col("distance") <= radius)
            .select("fingerprint", "found", "distance").distinct())


def count_within_radius(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                        part: int = TABLE_PART) -> DataFrame:
    """(fingerprint, n_within_radius): how many other distinct fingerprints of `prints` are within
    `radius` bits; without those that have none.

    The same tables, but pairs are counted where they meet instead of being given out. A pair that
    meets in several tables counts in the first of them.
    """
    choices = list(combinations(range(blocks), blocks - radius))
    edges = _edges(blocks)
    masks = [((1 << 4 * (edges[b + 1] - edges[b])) - 1) << (BITS - 4 * edges[b + 1])
             for b in range(blocks)]
    masks = np.array([[m >> 64, m & (1 << 64) - 1] for m in masks], np.uint64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, _TASK):
            halves = np.stack([table.column(c).to_numpy().view(np.uint64)
                               for c in ("high", "low")], axis=1)
            columns = [table.column(c).to_numpy()
                       for c in ("table", "mine", "first_part", "second_part")]
            counts = np.zeros(len(halves), np.int64)
            ends = np.append(starts[1:], len(halves))
            for start, end in zip(starts[ends - starts > 1].tolist(),
                                  ends[ends - starts > 1].tolist(), strict=True):
                number, mine, one, other = (c[start:end] for c in columns)
                group = halves[start:end]
                for k in range(len(group) - 1):
                    differing = group[k + 1:] ^ group[k]
                    near = np.bitwise_count(differing).sum(axis=1) <= radius
                    if one[0] != other[0]:
                        near &= mine[k + 1:] != mine[k]
                    at = np.flatnonzero(near)
                    if not len(at):
                        continue
                    agree = ((differing[at, None, :] & masks) == 0).all(axis=2)
                    met = np.array([agree[:, list(c)].all(axis=1) for c in choices[:number[0] + 1]])
                    at = at[met[-1] & ~met[:-1].any(axis=0)]
                    counts[start + k] += len(at)
                    counts[start + k + 1 + at] += 1
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [table.column("fingerprint").take(pa.array(some)).combine_chunks().cast(pa.string()),
                 pa.array(counts[some])], ["fingerprint", "n"])

    def half(start: int) -> F.Column:
        first, second = (F.conv(F.substring("fingerprint", start + d, 8), 16, 10).cast("bigint")
                         for d in (0, 8))
        return F.shiftleft(first, 32).bitwiseOR(second)

    rows = _tables(prints, radius, blocks).withColumn("bucket", F.xxhash64("key"))
    dealt = (dealt_by_parts(rows.select("table", "bucket", "fingerprint"), ["table", "bucket"],
                            "fingerprint", part)
             .withColumns({"high": half(1), "low": half(17)})
             .repartition(*_TASK).sortWithinPartitions(*_TASK))
    return (arrow_map(dealt, counted, "fingerprint string, n bigint")
            .groupBy("fingerprint").agg(F.sum("n").alias("n_within_radius")))


def edited_text(text: str, following: str) -> str:
    """The last quarter of the text's characters replaced by as many first ones of the next."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _compared(doc_id: int | None, text: str, own: bytes, following: str, other: bytes) -> tuple:
    edited = edited_text(text, following).encode()
    changed = simhash(edited)
    return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), own.hex(), changed.hex(),
            likeness(own, changed), likeness(own, other))


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's beginning.

    Next is by ascending doc_id, then text key, nulls first; after the last comes the first. One
    shuffle by doc_id ranges: a task works through its range in order and leaves open only its last
    document, which is then joined with the first one of the next range.
    """
    rows = documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(parts, "doc_id", "text_key")
             .sortWithinPartitions("doc_id", "text_key"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64())]
                       + [(c, pa.string()) for c in ("edited_sha256", "fingerprint",
                                                     "edited_fingerprint")]
                       + [(c, pa.float64()) for c in ("near_edited", "near_next")]
                       + [("part", pa.int32()), ("first_text", pa.string()),
                          ("last_text", pa.string())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), schema,
                                                                   strict=True)], schema=schema)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last = TaskContext.get().partitionId(), None, None
        for batch in slices(batches):
            done = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch),
                                    strict=True):
                now = (doc_id, text.decode(), simhash(text))
                if last is None:
                    first = now[1]
                else:
                    done.append((*_compared(*last, *now[1:]), None, None, None))
                last = now
            if done:
                yield batch_of(done)
        if last is not None:
            yield batch_of([(last[0], *[None] * 6, part, first, last[1])])

    found = stored(arrow_map(dealt, in_order,
                             f"{_RESULT}, part int, first_text string, last_text string"), "edits")
    # One row for each range from here on.
    ends = found.where("part is not null")
    order = sorted(r["part"] for r in ends.select("part").collect())
    columns = [c for c in found.columns if c not in ("part", "first_text", "last_text")]
    whole = found.where("part is null").select(*columns)
    if not order:
        return whole
    following = F.create_map(*(F.lit(x) for pair in zip(order, order[1:] + order[:1], strict=True)
                               for x in pair))
    firsts = ends.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    open_rows = (ends.select("doc_id", F.col("last_text").alias("text"),
                             following[F.col("part")].alias("next_part"))
                 .join(firsts, "next_part"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [_compared(doc_id, text, simhash(text.encode()), other, simhash(other.encode()))
                    for doc_id, text, other in zip(
                        *(batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text")),
                        strict=True)]
            yield batch_of([(*r, None, None, None) for r in rows]).select(columns)

    return whole.unionByName(arrow_map(open_rows, joined, _RESULT))
