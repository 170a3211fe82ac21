"""Whitening of embeddings by a bit-sliced scatter matrix.

An entry c becomes the whole number x = floor(scale * c). The fit list holds every distinct x vector
once. Its cross-products are exact: each dimension, less its least value, is a number of few bits; a
bit of it across 64 rows is one machine word. So the sum of products of two dimensions is the
sum over their pairs of bit planes of 2^(bit + bit) times the bits that both planes have set, an AND
and a population count. The scatter is centred in whole numbers, n * sum(x y) - sum(x) * sum(y),
before anything is rounded; its eigenvectors give the components.

Shuffled are the distinct vectors, in as few bytes as the range of the entries needs, and one sum per
pair of dimensions and task. The driver gets matrices of the dimension alone.

Rows whose vector is null or holds null, NaN or infinite entries are dropped. So are rows whose vector
has another length than most (of equally common lengths the longer counts), and empty vectors. Repeated
rows, and rows that repeat a vec_id, each get their rows; they count once in the fit. Entries beyond
+-2^61 / scale count as that. A component without variance (one distinct vector, or fewer independent
dimensions than components) is whitened to null, explains 0 and is left out of the identity error.
Components of equal eigenvalue come in any basis of their space. Empty table: no rows. Other columns are
not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, stored

SCALE = 256
COMPONENTS = 4

# Rows whose bit planes are held at once.
_ROWS = 1 << 15
_LIMIT = 1 << 61
_LIMB = 60
# Below this share of the trace an eigenvalue is rounding.
_NOTHING = 1e-13


def whole_numbers(column: pa.Array, scale: int, length: int | None = None
                  ) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows that can be used, and their x vectors by length; of one length alone if given."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = np.isfinite(entries)
    ends = np.cumsum(lengths)
    bad_before = np.concatenate([[0], np.cumsum(~good)])
    usable = (lengths > 0) & (bad_before[ends] == bad_before[ends - lengths])
    found = {}
    for size in ([length] if length else np.unique(lengths[usable]).tolist()):
        rows = np.flatnonzero(usable & (lengths == size))
        if len(rows):
            taken = entries[(ends[rows] - size)[:, None] + np.arange(size)]
            found[int(size)] = np.clip(np.floor(taken * scale), -_LIMIT, _LIMIT).astype(np.int64)
    return usable, found


def scatter(values: np.ndarray, widths: list[int]) -> list[list[int]]:
    """Upper triangle of sum(x y) over rows of non-negative numbers, `widths` bits per dimension."""
    size = len(widths)
    owner = np.repeat(np.arange(size), widths)
    bit = np.concatenate([np.arange(w) for w in widths]) if len(owner) else np.zeros(0, np.int64)
    counts = np.zeros((len(owner), len(owner)), np.int64)
    for start in range(0, len(values), _ROWS):
        part = values[start:start + _ROWS].astype(np.uint64)
        padded = np.zeros((-(-len(part) // 64) * 64, size), np.uint64)
        padded[:len(part)] = part
        planes = np.empty((len(owner), len(padded) // 64), np.uint64)
        for b in range(max(widths, default=0)):
            has = np.flatnonzero(bit == b)
            bits = ((padded[:, owner[has]] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
            planes[has] = np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.uint64)
        for k in range(len(owner)):
            counts[k, k:] += np.bitwise_count(planes[k:] & planes[k]).sum(axis=1, dtype=np.int64)
    counts += np.triu(counts, 1).T
    first = np.concatenate([[0], np.cumsum(widths)]).tolist()
    out = []
    for i in range(size):
        row = []
        for j in range(i, size):
            block = counts[first[i]:first[i + 1], first[j]:first[j + 1]].tolist()
            row.append(sum(n << (p + q) for p, line in enumerate(block) for q, n in enumerate(line)))
        out.append(row)
    return out


@dataclass(frozen=True)
class Whitening:
    """A fit: exact sums, and the components of the covariance."""

    scale: int
    rows: int
    least: list[int]
    widths: list[int]
    sums: list[int]             # of x - least
    vectors: np.ndarray         # dimension x components
    eigenvalues: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        return self.eigenvalues > _NOTHING * self.trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of x - S / n on the components, over the root of the eigenvalue; NaN without variance."""
        n, above = self.rows, x - np.array(self.least, np.int64)
        if max(self.widths) + n.bit_length() < 62:
            centred = (n * above - np.array(self.sums, np.int64)) / n
        else:
            exact = n * above.astype(object) - np.array(self.sums, object)
            centred = (exact / n).astype(np.float64)
        roots = np.sqrt(np.where(self.usable, self.eigenvalues, np.nan))
        return centred @ self.vectors / roots

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum over dimensions of (n x - S)^2, from n (x - least) - (S - n least)."""
        n, sums = self.rows, np.array(self.sums, object)
        above = x - np.array(self.least, np.int64)
        spare = 2 * max(self.widths) + len(self.widths).bit_length()
        if spare + 31 >= 62:
            return ((n * above.astype(object) - sums) ** 2).sum(axis=1).tolist()
        squares = (above * above).sum(axis=1).astype(object)
        # Sums cut into digits of 31 bits keep each product below 2^63.
        crossed, shift = np.zeros(len(x), object), 0
        while (sums >> shift).any():
            digit = ((sums >> shift) & ((1 << 31) - 1)).astype(np.int64)
            crossed = crossed + ((above @ digit).astype(object) << shift)
            shift += 31
        return (n * n * squares - 2 * n * crossed + int((sums * sums).sum())).tolist()


def _widths(vectors: DataFrame, column: str, scale: int) -> tuple[list[int], list[int]]:
    """Least value of every dimension, and the bits that its range needs."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for size, x in whole_numbers(batch.column(0), scale)[1].items():
                rows, low, high = seen.get(size, (0, x[0], x[0]))
                seen[size] = (rows + len(x), np.minimum(low, x.min(axis=0)),
                              np.maximum(high, x.max(axis=0)))
        places = [np.arange(size) for size in seen]
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(seen), list(seen))),
                 pa.array(np.concatenate(places)),
                 pa.array(np.repeat([s[0] for s in seen.values()], list(seen))),
                 pa.array(np.concatenate([s[1] for s in seen.values()])),
                 pa.array(np.concatenate([s[2] for s in seen.values()]))],
                ["size", "place", "rows", "low", "high"])

    found = stored(arrow_map(
        vectors.select(column), measured,
        "size bigint, place bigint, rows bigint, low bigint, high bigint"), "entry-ranges")
    lengths = (found.where("place = 0").groupBy("size").agg(F.sum("rows").alias("rows"))
               .orderBy(F.desc("rows"), F.desc("size")).first())
    if lengths is None:
        return [], []
    ranges = (found.where(F.col("size") == lengths["size"]).groupBy("place")
              .agg(F.min("low"), F.max("high")).orderBy("place").collect())
    return [r[1] for r in ranges], [max(1, (r[2] - r[1]).bit_length()) for r in ranges]


def _distinct(vectors: DataFrame, column: str, scale: int, least: list[int],
              widths: list[int]) -> DataFrame:
    """The distinct x vectors, less the least values, as bytes."""
    width = next(w for w in (8, 16, 32, 64) if max(widths) <= w)
    low = np.array(least, np.int64)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(0), scale, len(low))[1].get(len(low))
            if x is not None:
                rows = (x - low).astype(f"<u{width // 8}")
                size = rows.shape[1] * rows.itemsize
                flat = pa.py_buffer(rows.tobytes())
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                    pa.binary(size), len(rows), [None, flat]).cast(pa.binary())], ["packed"])

    return arrow_map(vectors.select(column), packed, "packed binary").distinct()


def _unpacked(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    joined = b"".join(batch.column("packed").to_pylist())
    return np.frombuffer(joined, f"<u{len(joined) // (batch.num_rows * dimensions)}").reshape(
        -1, dimensions)


def fit(vectors: DataFrame, column: str = "embedding", scale: int = SCALE,
        components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame | None]:
    """The whitening of the vectors, and the fit list it was made from (both None without vectors)."""
    least, widths = _widths(vectors, column, scale)
    if not least:
        return None, None
    size = len(least)
    fit_list = stored(_distinct(vectors, column, scale, least, widths), "distinct-vectors")

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(values: np.ndarray) -> pa.RecordBatch:
            # A column of ones gives the plain sums and the number of rows.
            ones = np.ones((len(values), 1), values.dtype)
            triangle = scatter(np.hstack([values, ones]), [*widths, 1])
            parts = [(i, i + k, *((v >> _LIMB * p) & ((1 << _LIMB) - 1) for p in range(3)))
                     for i, row in enumerate(triangle) for k, v in enumerate(row)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*parts, strict=True)], ["i", "j", *"abc"])

        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(_unpacked(batch, size))
                rows += batch.num_rows
            if rows >= _ROWS:
                yield sums(np.concatenate(held))
                held, rows = [], 0
        if held:
            yield sums(np.concatenate(held))

    # A total may be longer than a decimal, so its three limbs are added up each by itself.
    totals = (arrow_map(fit_list, sliced, "i bigint, j bigint, a bigint, b bigint, c bigint")
              .groupBy("i", "j").agg(*(F.sum(F.col(c).cast("decimal(19,0)")).alias(c) for c in "abc"))
              .collect())
    product = {(r["i"], r["j"]): sum(int(r[c]) << _LIMB * p for p, c in enumerate("abc"))
               for r in totals}
    rows = product[size, size]
    sums = [product[i, size] for i in range(size)]
    centred = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            # Whole numbers up to the last division, which rounds once.
            exact = rows * product[i, j] - sums[i] * sums[j]
            centred[i, j] = centred[j, i] = exact / (rows * rows)
    eigenvalues, eigenvectors = np.linalg.eigh(centred)
    chosen = np.argsort(-eigenvalues, kind="stable")[:components]
    return Whitening(scale, rows, least, widths, sums, np.ascontiguousarray(eigenvectors[:, chosen]),
                     eigenvalues[chosen], float(np.trace(centred))), fit_list


def identity_error(model: Whitening, fit_list: DataFrame) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    places = np.flatnonzero(model.usable).tolist()
    if not places:
        return 0.0
    low = np.array(model.least, np.int64)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unpacked(batch, len(low)).astype(np.int64) + low
                columns = model.whitened(x).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[k]) for k in places], [f"w{k}" for k in places])

    whitened = arrow_map(fit_list, projected, ", ".join(f"w{k} double" for k in places))
    pairs = [(a, b) for a in places for b in places if a <= b]
    # Aggregates of the co-moments, which are centred and merge between tasks.
    found = whitened.agg(*(F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs)).first()
    return max(abs(value - (a == b)) for (a, b), value in zip(pairs, found, strict=True))


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: the key, component, n, deviation, whitened, explained,
    identity_error. `deviation` is decimal(38,0), null beyond it."""
    out = (f"{key} bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
           "explained double, identity_error double")
    model, fit_list = fit(vectors, column, scale, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)
    error, dimensions = identity_error(model, fit_list), len(model.least)
    shown = len(model.eigenvalues)
    share = np.where(model.usable, model.eigenvalues, 0.0) / (model.trace or 1.0)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, found = whole_numbers(batch.column("vector"), scale, dimensions)
            x = found.get(dimensions)
            if x is None:
                continue
            lengths = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(usable & (lengths == dimensions))
            keys = batch.column("key").take(pa.array(np.repeat(rows, shown)))
            values = model.whitened(x).ravel()
            deviations = [str(d) for d in model.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(rows))),
                 pa.array(values, mask=np.isnan(values)),
                 pa.array(deviations).take(pa.array(np.repeat(np.arange(len(rows)), shown))),
                 pa.array(np.tile(share, len(rows)))],
                ["key", "component", "whitened", "deviation", "explained"])

    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(column).alias("vector"))
    return arrow_map(rows, projected, "key bigint, component int, whitened double, "
                     "deviation string, explained double").select(
        F.col("key").alias(key), "component", F.lit(model.rows).cast("bigint").alias("n"),
        F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"), "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"))
