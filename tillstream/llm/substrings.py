"""Repeated passages across documents, by super-k-mers.

Words are runs of anything but ASCII white space. A window is `window` consecutive words of one
document. A window whose word sequence also starts in a document with a smaller doc_id loses all
its words, in the document with the larger one.

1. A window's minimiser is the least hash among its sequences of `MINIMISER_WORDS` words. Runs of
   consecutive windows with one minimiser are noted by place and a digest of their words.
2. Minimisers that occur in one document alone can't belong to a repeated window; they go no further.
   Of equal runs only the one with the least doc_id does; the others lose all their words. Both
   are told by minima that are partly taken before the shuffle, so copies cost little.
3. What is left, if its minimiser has several different runs, travels: each run as one packed string
   of its words, to the bucket of its minimiser.
4. A bucket numbers its words and sorts its windows by rank doubling (ranks of 1, 2, 4 ... words),
   which compares the words themselves. Each window is judged against its least doc_id.
5. A minimiser with more than `BUCKET_RUNS` different runs would outgrow a bucket's memory. Its
   windows are counted singly, by 128-bit digests and again with a minimum before the shuffle.

Null text: no words. Documents of fewer words than a window keep all. Rows that repeat a doc_id
don't count against each other. A row whose doc_id is null keeps all and counts against none.
Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.llm.common import arrow_map, as_bytes, slices, stored, text_key

WINDOW_WORDS = 50
MINIMISER_WORDS = 8
BUCKET_RUNS = 20_000
BUCKET_WORDS = 1 << 18

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xFF51AFD7ED558CCD)
_KEYS = "doc_id bigint, text_key bigint"


class _WordHash(dict):
    """Word to its hash; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


@lru_cache(1)
def _word_hash() -> _WordHash:
    return _WordHash()


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs_of(words: list[list[bytes]], window: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimiser) of the runs of one minimiser in each text."""
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if total < window:
        return none, none, none, none
    known = _word_hash()
    hashes = np.fromiter((known[w] for some in words for w in some), np.uint64, total)
    few = min(MINIMISER_WORDS, window)
    mers = np.zeros(total - few + 1, np.uint64)
    for k in range(few):
        mers = mers * _FACTOR + hashes[k:total - few + 1 + k]
    mers = (mers ^ (mers >> np.uint64(31))) * _MIXER
    mers ^= mers >> np.uint64(29)
    least = _sliding_min(mers, window - few + 1)
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    whole = owner[:total - window + 1] == owner[window - 1:]
    at = np.flatnonzero(whole)
    if not len(at):
        return none, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = ((at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
               | (owner[at[1:]] != owner[at[:-1]]))
    starts = np.flatnonzero(new)
    place = at[starts]
    return (owner[place], place - first[owner[place]], np.diff(starts, append=len(at)),
            least[place].view(np.int64))


def _digests_of(words: list[list[bytes]], text: np.ndarray, start: np.ndarray,
                end: np.ndarray) -> np.ndarray:
    """Digest of the words from start to end in each text; runs come text by text."""
    out, now, joined, ends = np.zeros(len(text), np.uint64), -1, b"", np.zeros(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    for k, (t, a, b) in enumerate(zip(text.tolist(), start.tolist(), end.tolist(), strict=True)):
        if t != now:
            now, joined = t, b" ".join(words[t])
            ends = np.cumsum(np.fromiter(map(len, words[t]), np.int64, len(words[t])) + 1) - 1
        out[k] = digest(joined[ends[a - 1] + 1 if a else 0:ends[b - 1]])
    return out.view(np.int64)


def _runs(documents: DataFrame, window: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [text.split() for text in as_bytes(batch)]
            text, start, windows, minimiser = runs_of(words, window)
            digest = _digests_of(words, text, start, start + windows + window - 1)
            rows = batch.select(["doc_id", "text_key"]).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(start.astype(np.int32)),
                 pa.array(windows.astype(np.int32)), pa.array(minimiser), pa.array(digest)],
                ["doc_id", "text_key", "start", "windows", "minimiser", "digest"])

    return arrow_map(documents, found,
                     f"{_KEYS}, start int, windows int, minimiser bigint, digest bigint")


def _packed(documents: DataFrame, window: int) -> DataFrame:
    """The wanted runs as strings of their words."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [[], [], [], [], []]
            for doc_id, key, runs, text in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "runs")),
                    as_bytes(batch), strict=True):
                words = text.split()
                for run in runs:
                    start = run["start"]
                    end = start + run["windows"] + window - 1
                    for column, value in zip(out, (doc_id, key, start, run["minimiser"],
                                                   b" ".join(words[start:end])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(out, (
                    pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                ["doc_id", "text_key", "start", "minimiser", "packed"])

    return arrow_map(documents, pack,
                     f"{_KEYS}, start int, minimiser bigint, packed binary")


class _Numbers(dict):
    """Word to its number, by first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def repeated(packed: list[bytes], doc_ids: np.ndarray,
             window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, windows) of those runs that also start under a smaller doc_id."""
    numbers = _Numbers()
    words = [text.split() for text in packed]
    sizes = np.array([len(w) for w in words], np.int64)
    ranks = np.fromiter((numbers[w] for some in words for w in some), np.int64, int(sizes.sum()))
    del words, numbers
    span = 1
    while span < window:
        # Ranks of twice the words, or of the last step to the whole window.
        ahead = min(span, window - span)
        pairs = ranks[:len(ranks) - ahead] * (ranks.max() + 1) + ranks[ahead:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        span += ahead
    owner = np.repeat(np.arange(len(packed)), sizes - window + 1)
    place = np.arange(len(owner)) - np.repeat(
        np.cumsum(sizes - window + 1) - (sizes - window + 1), sizes - window + 1)
    first = np.cumsum(sizes) - sizes
    ranks = ranks[first[owner] + place]
    least = np.full(int(ranks.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, ranks, doc_ids[owner])
    at = np.flatnonzero(doc_ids[owner] > least[ranks])
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    starts = np.flatnonzero(new)
    return owner[at[starts]], place[at[starts]], np.diff(starts, append=len(at))


def _judge(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows; packed runs come sorted by minimiser and are judged in whole buckets."""

    def judged(table: pa.Table) -> pa.RecordBatch:
        start = table.column("start").to_numpy()
        owner, place, windows = repeated(
            table.column("packed").to_pylist(), table.column("doc_id").to_numpy(), window)
        rows = table.select(["doc_id", "text_key"]).take(pa.array(owner)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c.to_numpy()) for c in rows.columns),
             pa.array((start[owner] + place).astype(np.int32)),
             pa.array(windows.astype(np.int32))], ["doc_id", "text_key", "start", "windows"])

    held: list[pa.RecordBatch] = []
    most = BUCKET_WORDS * 8
    for batch in slices(batches, "packed", most):
        held.append(batch)
        if sum(b.column("packed").nbytes for b in held) >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            minimiser = table.column("minimiser").to_numpy()
            # The last bucket may go on in the next batch.
            whole = int(np.searchsorted(minimiser, minimiser[-1]))
            if whole:
                yield judged(table.slice(0, whole))
            held = table.slice(whole).to_batches()
    if sum(b.num_rows for b in held):
        yield judged(pa.Table.from_batches(held).combine_chunks())


def _digests(documents: DataFrame, window: int) -> DataFrame:
    """Every window of the wanted runs with a 128-bit digest of its words."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            rows, starts, digests = [], [], []
            for row, (runs, text) in enumerate(zip(batch.column("runs").to_pylist(),
                                                   as_bytes(batch), strict=True)):
                words = text.split()
                for run in runs:
                    for start in range(run["start"], run["start"] + run["windows"]):
                        rows.append(row)
                        starts.append(start)
                        digests.append(xxhash.xxh3_128_digest(
                            b" ".join(words[start:start + window])))
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            keys = batch.select(["doc_id", "text_key"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(starts, pa.int32()),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                ["doc_id", "text_key", "start", "high", "low"])

    return arrow_map(documents, digested, f"{_KEYS}, start int, high bigint, low bigint")


def _keep(found: DataFrame, name: str, carried: F.Column, text: F.Column, schema: StructType,
          window: int) -> DataFrame:
    """The carried column with n_words, n_removed and the words that no repeat covers."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, removed, texts = [], [], []
            for repeats, whole in zip(batch.column("repeats").to_pylist(), as_bytes(batch),
                                      strict=True):
                words = whole.split()
                counts.append(len(words))
                if repeats:
                    edges = np.zeros(len(words) + 1, np.int64)
                    for run in repeats:
                        edges[run["start"]] += 1
                        edges[run["start"] + run["windows"] + window - 1] -= 1
                    stay = np.cumsum(edges)[:-1] == 0
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                removed.append(counts[-1] - len(words))
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                [name, "n_words", "n_removed", "kept"])

    schema = (schema.add("n_words", "long").add("n_removed", "long").add("kept", "string"))
    return arrow_map(found.select(carried.alias(name), text.alias("text"), "repeats"), kept, schema)


def find_repeats(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, text_key, repeats): runs (start, windows) of each document's repeated windows."""
    named = _named(documents)
    runs = stored(_runs(named, window), "runs")
    distinct = runs.groupBy("minimiser", "digest").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    shared = (distinct.groupBy("minimiser")
              .agg(F.min("first_doc").alias("least"), F.max("last_doc").alias("most"),
                   F.count("*").alias("different"))
              .where("least != most").select("minimiser", "different"))
    judged = stored(
        runs.join(distinct.join(shared, "minimiser").drop("last_doc"), ["minimiser", "digest"])
        .where("different > 1 or doc_id > first_doc"), "judged-runs")
    copies = judged.where("doc_id > first_doc").select("doc_id", "text_key", "start", "windows")
    wanted = judged.where("doc_id = first_doc").groupBy(
        "doc_id", "text_key", (F.col("different") > BUCKET_RUNS).alias("hot")).agg(
        F.collect_set(F.struct("start", "windows", "minimiser")).alias("runs"))

    def of(hot: bool) -> DataFrame:
        return named.join(wanted.where(F.col("hot") == hot).drop("hot"), ["doc_id", "text_key"])

    strings = _packed(of(False), window).repartition("minimiser").sortWithinPartitions("minimiser")
    in_buckets = arrow_map(strings, lambda batches: _judge(batches, window),
                           f"{_KEYS}, start int, windows int")
    digests = _digests(of(True), window)
    first = digests.groupBy("high", "low").agg(F.min("doc_id").alias("first_doc"))
    singly = (digests.join(first, ["high", "low"]).where("doc_id > first_doc")
              .select("doc_id", "text_key", "start", F.lit(1).alias("windows")))
    return (copies.unionByName(in_buckets).unionByName(singly).groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.struct("start", "windows")).alias("repeats")))


def _named(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), "text"
    ).where("doc_id is not null")


def remove_repeats(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (words joined by a space)."""
    found = _named(documents).join(find_repeats(documents, window), ["doc_id", "text_key"], "left")
    unnamed = documents.where("doc_id is null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.lit(None).cast("array<struct<start: int, windows: int>>").alias("repeats"))
    found = found.select("doc_id", "text", "repeats").unionByName(unnamed)
    schema = StructType().add("doc_id", "long")
    return _keep(found, "doc_id", F.col("doc_id"), F.col("text"), schema, window)


def cleaned(documents: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The documents, all their columns, without repeats. A text that loses nothing stays as it is,
    another one is what is left joined by spaces; n_chars, where there is one, follows it."""
    repeats = find_repeats(documents, window)
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    same = ((F.col("row.doc_id").cast("bigint") == repeats["doc_id"])
            & (text_key(F.col("row.text")) == repeats["text_key"]))
    found = rows.join(repeats, same, "left").select("row", "repeats")
    schema = StructType().add("row", documents.schema)
    kept = _keep(found, "row", F.col("row"), F.col("row.text"), schema, window)
    columns = {c: F.col("row")[c] for c in documents.columns}
    changed = F.col("n_removed") > 0
    columns["text"] = F.when(changed, F.col("kept")).otherwise(columns["text"])
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.char_length("kept").cast(kind)).otherwise(
            columns["n_chars"])
    return kept.select(*(value.alias(name) for name, value in columns.items()))
