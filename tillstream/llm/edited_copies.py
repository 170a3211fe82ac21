"""Near-duplicates by Jaccard similarity of word shingles: a grid over SimHash bit counts finds, exact
sets decide.

The way is that of `near_dedup`, for a longer fingerprint. A text gets a SimHash of `BITS` bits over its
distinct shingles. It is embedded as the bit counts of its segments of two bits; the Manhattan distance of
two embeddings is never above the Hamming distance of the fingerprints. The segments are dealt to parts
of `PART_SEGMENTS`, `DEALS` times anew. Each part has a grid with a cell for every vector of counts. Two
embeddings at a distance below 32 equal each other in a part (no change of a segment touches more than two
of a deal's 48, and one of each 64 bits is in two), so they meet there for certain; farther ones meet with
a chance that falls with the distance. What meets is verified: at most
`REACH` of the first 128 bits may differ. Candidates are joined to clusters, and inside a cluster the texts
are compared by the exact similarity of their shingle sets until its links are spanned.

At a similarity of 0.8 some 15 % of the bits differ, in 27 % of the segments. A part of two such
fingerprints is equal in 3 % of the cases, and of such pairs about 1 % share no cell of the 144 parts; such a
pair is still compared if other texts lead from one to the other. Pairs above it are missed more rarely.
Cells a step away, which serve `near_dedup`'s half of a fingerprint, would give each part tenfold the rows
for four times the chance; more parts find the same with fewer rows.

Only distinct shingle sets enter grids. The grids are gone through in rounds of ever more parts;
after a round what is joined counts as one, so a large group of near copies is joined by the first few
grids and gives no more links from the others. Full cells and large clusters are dealt to tasks by
`linking`, in rows linear in their size if they are tight.

Words are those of `near_dedup.simhash`. A text of fewer words than a shingle is one shingle; texts
without words equal each other. Very long texts are shingled whole. Null text counts as empty. Rows that
repeat a doc_id each get a row, each with the component of its own text. Ties don't arise: a component is
named by its least doc_id. A null doc_id counts for no component id unless there is none other. Empty
table: no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import (
    arrow_map,
    as_bytes,
    slices,
    stored,
    text_key,
)
from tillstream.llm.linking import contracted, linked, spread
from tillstream.llm.near_dedup import segment_counts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BITS = 1024
REACH = 32
CELL_PART = 2048
CLUSTER_PART = 256
# Segments of two bits in 64 bits of the SimHash, those of a part, and how often they are dealt anew.
WORD_SEGMENTS = 32
PART_SEGMENTS = 11
DEALS = 3
# Parts of each round, 144 in all. The first few join large groups.
ROUNDS = (4, 20, 60, 60)
# In cells of so many all pairs are looked at, at once for all cells.
SMALL_CELL = 16

_SEEDS = np.random.default_rng(6).integers(1, 2**63, BITS // 64, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _parts() -> list[tuple[int, int]]:
    """(word, mask of the counts of its segments) of all parts, deal by deal. Those of a deal cover all
    segments."""
    random, out = np.random.default_rng(9), []
    firsts = [*range(0, WORD_SEGMENTS - PART_SEGMENTS, PART_SEGMENTS), WORD_SEGMENTS - PART_SEGMENTS]
    for _ in range(DEALS):
        dealt = [random.permutation(WORD_SEGMENTS) for _ in range(BITS // 64)]
        for first in firsts:
            for word, order in enumerate(dealt):
                mask = sum(3 << 2 * int(k) for k in order[first:first + PART_SEGMENTS])
                out.append((word, mask - (1 << 64) if mask >> 63 else mask))
    return out


PARTS = _parts()


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of the distinct shingles, ascending."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.unique(np.array([digest(joined[i:j]) for i, j in zip(
        starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist(), strict=True)], np.uint64))


def simhash(hashes: np.ndarray) -> bytes:
    """Bit by bit the majority of `BITS` bits mixed from each hash."""
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 12):
        mixed = hashes[start:start + (1 << 12), None] * _SEEDS
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
        mixed ^= mixed >> np.uint64(29)
        votes += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(hashes)).tobytes()


def _hashed(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_key, set_key, print) of every row; set_key names the set of shingles."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(text, words) for text in as_bytes(batch)]
            keys = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys.view(np.int64)),
                 pa.array([np.frombuffer(simhash(s), np.int64) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "text_key", "set_key", "print"])

    rows = documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
    return arrow_map(rows, hashed, "doc_id bigint, text_key bigint, set_key bigint, print array<bigint>")


def _near(prints: np.ndarray, member: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints ^ member).sum(axis=-1, dtype=np.int64) <= REACH


def _cell_candidates(table: pa.Table, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of roots that connect the candidates of each cell."""
    root = table.column("root").to_numpy()
    prints = np.stack([table.column(c).to_numpy().view(np.uint64) for c in ("high", "low")], axis=1)
    sizes = np.diff(starts, append=len(root))
    size = np.repeat(sizes, sizes)
    place = np.arange(len(root)) - np.repeat(starts, sizes)
    found = []
    for step in range(1, SMALL_CELL):
        at = np.flatnonzero((size <= SMALL_CELL) & (place + step < size))
        at = at[root[at] != root[at + step]]
        at = at[_near(prints[at], prints[at + step])]
        found.append((root[at], root[at + step]))
    for start, end in zip(starts[sizes > SMALL_CELL].tolist(),
                          (starts + sizes)[sizes > SMALL_CELL].tolist(), strict=True):
        own, here = root[start:end], prints[start:end]
        for member, reached in spread(
                end - start, lambda m, places, here=here: _near(here[places], here[m]), own):
            found.append((np.full(len(reached), own[member]), own[reached]))
    return found


def candidates(prints: DataFrame, part: int = CELL_PART) -> DataFrame:
    """(set_key, root) of all: those whose embeddings share a cell of a part's grid and whose prints are
    within reach have a root in common."""
    sets = stored(prints.select("set_key", F.col("set_key").alias("root"), "print"), "clusters")
    first = 0
    for size in ROUNDS:
        # The counts of a part, the others left out, are its cell. One expression for all parts: the
        # driver's plans don't grow with them.
        parts = F.array(*(F.struct(F.lit(i).alias("part"), F.lit(word).alias("word"),
                                   F.lit(mask).cast("bigint").alias("mask"))
                          for i, (word, mask) in enumerate(PARTS[first:first + size], first)))
        counts = sets.select("set_key", "root", "print",
                             F.transform("print", segment_counts).alias("counts"))
        cells = counts.select(
            F.col("set_key").alias("member"), "root", F.col("print")[0].alias("high"),
            F.col("print")[1].alias("low"), F.inline(F.transform(parts, lambda p: F.struct(
                p["part"].alias("part"),
                F.get("counts", p["word"]).bitwiseAND(p["mask"]).alias("cell")))))
        joined = linked(cells, ["part", "cell"], _cell_candidates, part)
        sets = stored(contracted(sets, joined), "clusters")
        first += size
    return sets.select("set_key", "root")


def _similar(sets: list[np.ndarray], root: np.ndarray,
             similarity: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of roots that connect all sets of at least this Jaccard similarity."""
    sizes = np.array([len(s) for s in sets])
    values, of_set = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, of_set = values[order], of_set[order]

    def near(member: int, places: np.ndarray) -> np.ndarray:
        first = np.searchsorted(values, sets[member])
        last = np.searchsorted(values, sets[member], "right")
        holders = [of_set[i:j] for i, j in zip(first.tolist(), last.tolist(), strict=True) if j - i > 1]
        common = (np.bincount(np.concatenate(holders), minlength=len(sets)) if holders
                  else np.zeros(len(sets), np.int64))[places]
        return common >= similarity * (sizes[places] + sizes[member] - common)

    return [(np.full(len(reached), root[member]), root[reached])
            for member, reached in spread(len(sets), near, root)]


def links(documents: DataFrame, hashed: DataFrame, words: int = SHINGLE_WORDS,
          similarity: float = SIMILARITY, part: int = CLUSTER_PART) -> DataFrame:
    """(root, joined) of set_keys that are similar to another one inside the clusters of candidates."""
    # One row stands for each set.
    sets = hashed.groupBy("set_key").agg(F.first("print").alias("print"),
                                         F.min(F.struct("doc_id", "text_key")).alias("at"))
    sets = stored(sets, "shingle-sets")
    found = candidates(sets.select("set_key", "print"))
    several = found.groupBy("root").count().where("count > 1").select("root")
    clusters = found.join(several, "root").select("set_key", F.col("root").alias("cluster"))
    wanted = sets.join(clusters, "set_key").select("set_key", "cluster", "at.*")
    same = (F.col("d.text_key") == F.col("w.text_key")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    rows = (documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
            .alias("d").join(wanted.alias("w"), same)
            .select("w.cluster", "w.set_key", "d.text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("cluster"), batch.column("set_key"), batch.column("set_key"),
                 pa.array([shingles(t, words).tobytes() for t in as_bytes(batch)], pa.binary())],
                ["cluster", "member", "root", "shingles"])

    def compared(table: pa.Table, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        keys, values, out = table.column("root").to_numpy(), table.column("shingles"), []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
            sets = [np.frombuffer(v, np.uint64) for v in values[start:end].to_pylist()]
            out += _similar(sets, keys[start:end], similarity)
        return out

    held = stored(arrow_map(rows, cut, "cluster bigint, member bigint, root bigint, shingles binary"),
                  "cluster-sets")
    return linked(held, ["cluster"], compared, part, batch_rows=64)


def components(documents: DataFrame, words: int = SHINGLE_WORDS,
               similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, text_key, component_id."""
    hashed = stored(_hashed(documents, words), "shingle-prints")
    root_of = links(documents, hashed, words, similarity).select(
        F.col("root").alias("set_key"), F.col("joined").alias("root"))
    sets = hashed.groupBy("set_key").agg(F.min("doc_id").alias("first_doc")).join(
        root_of, "set_key", "left").select(
        "set_key", "first_doc", F.coalesce("root", "set_key").alias("root"))
    least = sets.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    of_set = sets.join(least, "root").select("set_key", "component_id")
    return hashed.join(of_set, "set_key").select("doc_id", "text_key", "component_id")
