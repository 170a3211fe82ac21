"""Toxicity by class-conditional Kneser-Ney models.

A text is a sequence of symbols: its UTF-8 bytes as they are, none taken for another, and one more
symbol around the text. Two models of `ORDER` symbols are fitted, to texts marked toxic and to all others. Both discount their own counts and give what they take
off to one shared backoff: the Kneser-Ney model of the shorter context, whose continuation counts come
from all documents, marked or not. So a rare expression that neither class has seen weighs alike in
both, and one that a single class has seen speaks for it.

What counts is the mean log-likelihood ratio per symbol. It becomes the score by a logistic function of
two parameters, fitted to all marked rows that aren't held out. Their ratios are taken without their own
counts, so they are like those of rows the models haven't seen.

A table holds the sequences of `ORDER` bytes that occur in the corpus. Text has few of them (132,000 in 173 MB,
growing ever slower), so models fit every task. Counts are summed by task before they travel, over all rows. To be counted by class, texts are
joined with their marks once; scoring has no shuffle but of one number per row and class.

Null text counts as empty. Marks with a null doc_id or value are left out; several marks of a doc_id count
by their mean, toxic from one half on. Without marks of both classes every score is 0. Rows that repeat a
doc_id each get a row. A null doc_id is scored and not held out. A long text is a slice of its own.
Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices, stored

SYMBOLS = 257
ORDER = 4
DISCOUNT = 0.75
# Steps of the ratio by which marked rows are counted for the logistic function.
STEPS = 4096
NEWTON_STEPS = 25
RIDGE = 1e-6

# Symbol of each byte: every byte value is one of its own, 0 is what stands around a text.
_SYMBOL = np.arange(1, SYMBOLS)


def codes(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all sequences of `order` symbols, a text's end included, and where each text's start."""
    before = b" " * (order - 1)
    joined = np.frombuffer(b"".join(before + t + b" " for t in texts), np.uint8)
    sizes = np.array([len(t) + order for t in texts], np.int64)
    ends = np.cumsum(sizes)
    symbols = _SYMBOL[joined]
    for k in range(order):
        symbols[ends - sizes + k - 1] = 0
    out = symbols[:len(symbols) - order + 1].copy()
    for k in range(1, order):
        out = out * SYMBOLS + symbols[k:len(symbols) - order + 1 + k]
    # What reaches over into the next text is no sequence.
    own = np.ones(len(symbols), bool)
    for k in range(1, order):
        own[ends - k] = False
    starts = np.concatenate([[0], np.cumsum(sizes - order + 1)[:-1]]) if texts else ends
    return out[own[:len(out)]], starts


def _counted(rows: DataFrame, order: int, marked: bool) -> DataFrame:
    """(toxic, code, count) over all rows, each task's counts summed."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[bool | None, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches):
            texts = as_bytes(batch)
            of = batch.column("toxic").to_pylist() if marked else [None] * len(texts)
            for mark in set(of):
                found, count = np.unique(codes(
                    [t for t, m in zip(texts, of, strict=True) if m == mark], order)[0],
                    return_counts=True)
                before, sums = totals.get(mark, (found[:0], count[:0]))
                # Both ascending and distinct, so every code is there once or twice.
                both, place = np.unique(np.concatenate([before, found]), return_inverse=True)
                added = np.zeros(len(both), np.int64)
                added[place[:len(before)]] = sums
                added[place[len(before):]] += count
                totals[mark] = both, added
        for mark, (found, count) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([mark] * len(found), pa.bool_()), pa.array(found),
                 pa.array(count)], ["toxic", "code", "count"])

    chosen = rows.select("text", "toxic") if marked else rows.select("text")
    return (arrow_map(chosen, counted, "toxic boolean, code bigint, count bigint")
            .groupBy("toxic", "code").agg(F.sum("count").alias("count")))


def shared_backoff(seen: np.ndarray, order: int = ORDER, wanted: np.ndarray | None = None) -> np.ndarray:
    """Kneser-Ney probabilities of a symbol after order - 2 others, by code or for the wanted codes, from
    the codes of `order` symbols that the corpus has."""
    types, levels = seen, []
    for size in range(order - 1, 0, -1):
        # Continuation counts: how many different symbols stand before a sequence.
        types, before = np.unique(types % SYMBOLS ** size, return_counts=True)
        levels.append((types, before))
    if wanted is None:
        wanted = np.arange(SYMBOLS ** (order - 1))
    types, before = levels.pop()
    single = np.full(SYMBOLS, 0.5)
    single[types] += before
    known = (single / single.sum())[wanted % SYMBOLS]
    for size in range(2, order):
        types, before = levels.pop()
        contexts, first, kinds = np.unique(types // SYMBOLS, return_index=True, return_counts=True)
        totals = np.add.reduceat(before, first)
        code = wanted % SYMBOLS ** size
        here, its_kinds = _at(contexts, code // SYMBOLS, totals, kinds)
        known = discounted(_at(types, code, before)[0], here, its_kinds, known)
    return known


def _at(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Values of the wanted keys, 0 for those that aren't among the ascending `keys`."""
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[place] == wanted
    return [np.where(there, v[place], 0) for v in values]


def discounted(counts: np.ndarray, totals: np.ndarray, kinds: np.ndarray,
               backoff: np.ndarray) -> np.ndarray:
    """Counts less the discount, and what they lose in a context given out by `backoff`. `totals` and
    `kinds` are those of the context; without any the backoff alone speaks."""
    some = np.maximum(totals, 1)
    share = np.maximum(counts - DISCOUNT, 0) / some + DISCOUNT * kinds / some * backoff
    return np.where((totals > 0) & (share > 0), share, backoff)


@dataclass(frozen=True)
class Models:
    """The codes of the corpus, ascending, their counts in both classes, ordinary first, and the backoff
    that these share."""

    order: int
    codes: np.ndarray
    counts: np.ndarray          # 2 x codes
    backoff: np.ndarray         # by code


class _Scorer:
    """Mean log-likelihood ratios of texts of the corpus."""

    def __init__(self, models: Models):
        self.models, self.order = models, models.order
        new = np.diff(models.codes // SYMBOLS) != 0
        at = np.flatnonzero(np.concatenate([[True], new]))
        group = np.cumsum(np.concatenate([[0], new]))
        self.totals = np.add.reduceat(models.counts, at, axis=1)[:, group]
        self.kinds = np.add.reduceat((models.counts > 0).astype(np.int64), at, axis=1)[:, group]
        self.log = np.log(discounted(models.counts, self.totals, self.kinds, models.backoff))

    def ratios(self, texts: list[bytes]) -> np.ndarray:
        """By text: the ratio, and the ratio if its own counts are taken off the ordinary or the toxic
        model."""
        if not texts:
            return np.zeros((0, 3))
        found, starts = codes(texts, self.order)
        sizes = np.diff(starts, append=len(found))
        width = SYMBOLS ** self.order
        pairs, own = np.unique(np.repeat(np.arange(len(texts)), sizes) * width + found,
                               return_counts=True)
        text, at = pairs // width, np.searchsorted(self.models.codes, pairs % width)
        first = np.searchsorted(text, np.arange(len(texts)))
        out = np.empty((len(texts), 3))
        out[:, 0] = np.add.reduceat(own * (self.log[1, at] - self.log[0, at]), first)
        # Codes of one context lie together.
        new = np.diff(pairs // SYMBOLS) != 0
        begins = np.flatnonzero(np.concatenate([[True], new]))
        group = np.cumsum(np.concatenate([[0], new]))
        lost = np.add.reduceat(own, begins)[group]
        for k in (0, 1):
            before = self.models.counts[k, at]
            gone = np.add.reduceat((before == own).astype(np.int64), begins)[group]
            log = np.log(discounted(np.maximum(before - own, 0), self.totals[k, at] - lost,
                                    np.maximum(self.kinds[k, at] - gone, 0),
                                    self.models.backoff[at]))
            other = self.log[1 - k, at]
            out[:, 1 + k] = np.add.reduceat(own * (log - other if k else other - log), first)
        return out / sizes[:, None]


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the marks to learn from."""
    return (labels.where("doc_id is not null and toxic is not null").where(~held_out())
            .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
            .agg((F.avg("toxic") >= 0.5).alias("toxic")))


def fit(documents: DataFrame, known: DataFrame, order: int = ORDER) -> Models | None:
    """Models of the documents marked in `known`; None without both classes."""
    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    # As many rows as different codes.
    # One kind of join at every size, built from the marks; texts aren't sorted for it.
    by_class = _counted(rows.join(known.hint("shuffle_hash"), "doc_id"), order, True).toArrow()
    marks_of, of_class, count = (by_class.column(c).to_numpy() for c in ("toxic", "code", "count"))
    if len(np.unique(marks_of)) < 2:
        return None
    seen = np.sort(_counted(rows, order, False).select("code").toArrow().column("code").to_numpy())
    counts = np.zeros((2, len(seen)), np.int64)
    counts[marks_of.astype(int), np.searchsorted(seen, of_class)] = count
    return Models(order, seen, counts, shared_backoff(seen, order, seen % SYMBOLS ** (order - 1)))


def logistic(ratio: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the marks likeliest; ridge against marks that split cleanly."""
    spread = float(np.sqrt(np.average((ratio - np.average(ratio, weights=weight)) ** 2,
                                      weights=weight))) or 1.0
    x = np.stack([ratio / spread, np.ones(len(ratio))], axis=1)
    total, beta = weight.sum(), np.zeros(2)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + RIDGE * total * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * total * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
    return float(beta[0] / spread), float(beta[1])


def score(documents: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    known = stored(marks(labels), "toxic-marks")
    models = fit(documents, known, order)
    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    if models is None:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit(0.0).alias("score"),
                           F.lit(0).alias("predicted"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(models)
        for batch in slices(batches):
            found = scorer.ratios(as_bytes(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[:, k].copy()) for k in range(3))],
                ["doc_id", "ratio", "as_ordinary", "as_toxic"])

    ratios = stored(arrow_map(rows, scored, "doc_id bigint, ratio double, as_ordinary double, "
                              "as_toxic double"), "toxic-ratios")
    without = F.when(F.col("toxic"), F.col("as_toxic")).otherwise(F.col("as_ordinary"))
    steps = (ratios.join(known, "doc_id")
             .groupBy(F.floor(without * STEPS).alias("step"), "toxic").count().collect())
    slope, offset = logistic(*(np.array(column, float) for column in zip(
        *((r["step"] + 0.5, r["toxic"], r["count"]) for r in steps), strict=True)))
    value = 1 / (1 + F.exp(-F.col("ratio") * (STEPS * slope) - offset))
    return ratios.select("doc_id", held_out().alias("held_out"), value.alias("score"),
                         (value >= 0.5).cast("int").alias("predicted"))
