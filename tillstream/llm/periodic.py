"""Periodic runs of words, found in a grammar of the texts.

A run is a stretch of consecutive words with smallest period q and a length of at least `REPEATS` * q
and `LEAST_WORDS`, which no neighbouring word extends. Every three words in a run of four periods
occur at least three times in their document. So first all words are set aside that no such triple
covers; runs lie within the segments that are left.

1. Re-Pair over the word ids of the segments: the most frequent pair of neighbouring symbols becomes a
   rule, over and over, until no pair occurs twice. What a segment ends up as is joined by rules of its
   own, two neighbours at a time.
2. Each rule derives one text, cut in two by its right-hand side. The runs that cross that cut are looked
   for once per rule, where the rule first occurs.
3. They are translated to all places where the rule occurs. A run lies whole in the text of the least
   rule around it and crosses its cut, so it is found there; parts of it, found in smaller rules, are
   merged into it.

Rules are shared by the documents of a slice; a long document is a slice of its own. Rows stay where they
are, there is no shuffle.

Null or empty text: no words, no runs, and the digests of nothing. Repeated rows: each counts by itself.
Two runs of one period may share words, fewer than the period. Empty table: no rows. Other columns are not
carried.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices

REPEATS = 4
LEAST_WORDS = 6
KNOWN_WORDS = 500_000

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
                    np.uint64)
_BUCKET_BITS = 21


def _triples_often(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of the triples of words that start at each place, those that occur three times or more in their
    document. A rare clash of hashes may keep too many, never too few."""
    if len(ids) < 3:
        return np.zeros(0, np.int64)
    words = ids.astype(np.uint64)
    mixed = (words[:-2] * _FACTORS[0] + words[1:-1] * _FACTORS[1] + words[2:] * _FACTORS[2]
             + owner[:-2].astype(np.uint64) * _FACTORS[3])
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[2]
    mixed ^= mixed >> np.uint64(32)
    whole = owner[:-2] == owner[2:]
    bucket = (mixed & np.uint64((1 << _BUCKET_BITS) - 1)).astype(np.int64)
    crowd = np.bincount(bucket[whole], minlength=1 << _BUCKET_BITS)
    at = np.flatnonzero(whole & (crowd[bucket] >= 3))
    _, inverse, counts = np.unique(mixed[at], return_inverse=True, return_counts=True)
    return at[counts[inverse] >= 3]


def segments(ids: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [start, end) outside of which no word belongs to a run."""
    at = _triples_often(ids, owner)
    if not len(at):
        return []
    # A triple covers its place and the two behind; stretches of different documents may touch.
    new = np.flatnonzero((np.diff(at) > 3) | (owner[at[1:]] != owner[at[:-1]])) + 1
    starts = at[np.concatenate([[0], new])]
    ends = at[np.concatenate([new - 1, [len(at) - 1]])] + 3
    long = ends - starts >= LEAST_WORDS
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


class Grammar:
    """Re-Pair over several sequences of symbols.

    A symbol below `first_rule` stands for itself, the others for the pair in `rules`. `sequences` holds
    what is left of each sequence.
    """

    def __init__(self, texts: list[list[int]]):
        self.first_rule = 1 + max((max(t) for t in texts if t), default=-1)
        self.rules: list[tuple[int, int]] = []
        # One list with a gap of -1 around every sequence; a replaced symbol's second place becomes
        # a gap to jump over, whose neighbours are in `after` and `before`.
        symbols = [-1]
        for text in texts:
            symbols += text
            symbols.append(-1)
        self.symbols = symbols
        self.after = list(range(1, len(symbols) + 1))
        self.before = list(range(-1, len(symbols) - 1))
        self._replace_all()
        self.sequences = []
        place = 1
        for text in texts:
            left, end = [], place + len(text)
            while place < end:
                left.append(symbols[place])
                place = self.after[place]
            self.sequences.append(left)
            place = end + 1

    def _replace_all(self) -> None:
        symbols, after, before = self.symbols, self.after, self.before
        places: dict[tuple[int, int], list[int]] = {}
        last = None
        for place in range(1, len(symbols) - 2):
            pair = symbols[place], symbols[place + 1]
            # Of a repeated symbol's overlapping pairs every other one counts.
            if pair[0] < 0 or pair[1] < 0 or (pair == last and pair[0] == pair[1]):
                last = None
                continue
            places.setdefault(pair, []).append(place)
            last = pair
        counts = {pair: len(found) for pair, found in places.items() if len(found) > 1}
        places = {pair: places[pair] for pair in counts}
        # Of equally frequent pairs the one seen first.
        order = {pair: k for k, pair in enumerate(counts)}
        heap = [(-count, order[pair], pair) for pair, count in counts.items()]
        heapq.heapify(heap)
        while heap:
            count, _, pair = heapq.heappop(heap)
            now = counts.get(pair, 0)
            if now != -count:
                if now > 1:
                    heapq.heappush(heap, (-now, order[pair], pair))
                continue
            a, b = pair
            rule = self.first_rule + len(self.rules)
            fresh: dict[tuple[int, int], list[int]] = {}
            done = 0
            del counts[pair]
            for place in places.pop(pair):
                second = after[place]
                if symbols[place] != a or symbols[second] != b or second <= place:
                    continue
                left, right = before[place], after[second]
                x, y = symbols[left], symbols[right]
                if x >= 0:
                    old = x, a
                    if old in counts:
                        counts[old] -= 1
                    fresh.setdefault((x, rule), []).append(left)
                if y >= 0:
                    old = b, y
                    if old in counts:
                        counts[old] -= 1
                    fresh.setdefault((rule, y), []).append(place)
                symbols[place], symbols[second] = rule, -2
                after[place], before[right] = right, place
                done += 1
            if not done:
                continue
            self.rules.append(pair)
            for found, at in fresh.items():
                # A place is stale if its symbols were replaced meanwhile.
                p, q = found
                alive, free = [], -1
                for place in at:
                    second = after[place]
                    if symbols[place] == p and symbols[second] == q and place != free:
                        alive.append(place)
                        free = second if p == q else -1
                if len(alive) > 1:
                    places[found] = alive
                    counts[found] = len(alive)
                    order[found] = len(order)
                    heapq.heappush(heap, (-len(alive), order[found], found))


def crossing_runs(text: np.ndarray, start: int, cut: int, end: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of what repeats in text[start:end] across `cut`, at least `REPEATS` times and
    over `LEAST_WORDS` words, as far as the stretch goes. Smallest periods only."""
    most = (end - start) // REPEATS
    if most < 1 or end - start < LEAST_WORDS:
        return []
    # The words before and behind the cut both belong to the run, and recur a period away on one side.
    one, two = text[cut - 1], text[cut]
    low, high = max(start, cut - most), min(end, cut + most + 1)
    behind = np.flatnonzero((text[cut + 1:high] == two) & (text[cut:high - 1] == one)) + 1
    ahead = text[low:cut] == two
    ahead[1:] &= text[low:cut - 1] == one
    if low > start:
        ahead[0] &= text[low - 1] == one
    else:
        ahead[0] = False
    ahead = cut - low - np.flatnonzero(ahead)
    if not len(behind) and not len(ahead):
        return []
    found: list[tuple[int, int, int]] = []
    for period in sorted({*behind.tolist(), *ahead.tolist()}):
        # Places i with text[i] == text[i + period], around the cut or a period before it.
        for anchor in (cut, cut - period):
            if anchor < start or anchor + period >= end:
                continue
            # Within a run of a divisor the period isn't the smallest.
            if any(period % q == 0 and begin <= anchor and anchor + period < stop
                   for begin, stop, q in found):
                continue
            last = _matches(text, anchor, anchor + period, end)
            if not last:
                continue
            first = _matches_back(text, anchor, anchor + period, start)
            begin, stop = anchor - first, anchor + last + period
            run = begin, stop, period
            # Two runs of one period may meet at the cut.
            if (begin < cut < stop and stop - begin >= max(LEAST_WORDS, REPEATS * period)
                    and run not in found):
                found.append(run)
    return found


def _matches(text: np.ndarray, left: int, right: int, end: int) -> int:
    """How many words from `left` on equal those from `right` on, before `end`."""
    if text[left] != text[right]:
        return 0
    done, step = 1, 8
    while right + done < end:
        size = min(step, end - right - done)
        differ = text[left + done:left + done + size] != text[right + done:right + done + size]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done += size
        step *= 4
    return done


def _matches_back(text: np.ndarray, left: int, right: int, start: int) -> int:
    """How many words before `left` equal those before `right`, not before `start`."""
    done, step = 0, 8
    while left - done > start:
        size = min(step, left - done - start)
        differ = (text[left - done - size:left - done] != text[right - done - size:right - done])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done += size
        step *= 4
    return done


def runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, by start and period."""
    sizes = [len(t) for t in texts]
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.cumsum(sizes) - sizes if texts else np.zeros(0, np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = segments(ids, owner)
    if not kept:
        return out
    few = np.unique(np.concatenate([ids[a:b] for a, b in kept]))
    grammar = Grammar([np.searchsorted(few, ids[a:b]).tolist() for a, b in kept])
    starts, ends, periods = _translated(grammar, ids, [a for a, _ in kept])
    if not len(starts):
        return out
    # Of one period, what lies within another goes. Ends are pushed apart by period for one running maximum.
    order = np.lexsort((-ends, starts, periods))
    starts, ends, periods = starts[order], ends[order], periods[order]
    rank = np.cumsum(np.concatenate([[0], np.diff(periods) != 0])) * (len(ids) + 1)
    reached = np.maximum.accumulate(ends + rank)
    whole = np.concatenate([[True], (ends + rank)[1:] > reached[:-1]])
    starts, ends, periods = starts[whole], ends[whole], periods[whole]
    for k in np.lexsort((periods, starts)).tolist():
        text = int(owner[starts[k]])
        out[text].append((int(starts[k] - first[text]), int(ends[k] - starts[k]), int(periods[k])))
    return out


def _translated(grammar: Grammar, ids: np.ndarray, starts: list[int]
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of what crosses the cuts, at all places of the rules."""
    base, rules = grammar.first_rule, list(grammar.rules)
    lengths = [1] * base
    for left, right in rules:
        lengths.append(lengths[left] + lengths[right])
    # What is left of a segment becomes one symbol, neighbours being joined level by level.
    tops = []
    for sequence in grammar.sequences:
        level = sequence
        while len(level) > 1:
            above = []
            for k in range(0, len(level) - 1, 2):
                rules.append((level[k], level[k + 1]))
                above.append(base + len(rules) - 1)
                lengths.append(lengths[level[k]] + lengths[level[k + 1]])
            level = above + level[len(level) - len(level) % 2:]
        tops.append(level[0])
    # First place of each rule: rules come behind their parts, so backwards a rule is placed before them.
    # The tops, too, come in order, so an earlier place wins by coming last.
    place = [-1] * (base + len(rules))
    for top, start in zip(reversed(tops), reversed(starts), strict=True):
        place[top] = start
    for symbol in range(base + len(rules) - 1, base - 1, -1):
        left, right = rules[symbol - base]
        place[left], place[right] = place[symbol], place[symbol] + lengths[left]
    crossing: dict[int, list[tuple[int, int, int]]] = {}
    holds = [False] * (base + len(rules))
    for symbol in range(base, base + len(rules)):
        left, right = rules[symbol - base]
        at, size = place[symbol], lengths[symbol]
        if size >= LEAST_WORDS:
            found = crossing_runs(ids, at, at + lengths[left], at + size)
            if found:
                crossing[symbol] = [(a - at, b - at, q) for a, b, q in found]
                holds[symbol] = True
            elif holds[left] or holds[right]:
                holds[symbol] = True
    # All places, from the tops down; what holds nothing isn't entered.
    places: dict[int, list] = {}
    for top, start in zip(tops, starts, strict=True):
        if holds[top]:
            places.setdefault(top, []).append(np.array([start], np.int64))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for symbol in range(base + len(rules) - 1, base - 1, -1):
        if symbol not in places:
            continue
        at = places.pop(symbol)
        at = at[0] if len(at) == 1 else np.concatenate(at)
        for a, b, q in crossing.get(symbol, ()):
            out.append((at + a, at + b, np.full(len(at), q)))
        left, right = rules[symbol - base]
        if holds[left]:
            places.setdefault(left, []).append(at)
        if holds[right]:
            places.setdefault(right, []).append(at + lengths[left])
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words but those that a run has after its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return [words[k] for k in np.flatnonzero(stays).tolist()]


def longest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first, then of the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


class _Numbers(dict):
    """Word to a number; the same in all slices of a worker until there are too many."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def of(self, words: list[list[bytes]]) -> list[np.ndarray]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        return [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in words]


@lru_cache(1)
def _numbers() -> _Numbers:
    return _Numbers()


def find_runs(documents: DataFrame, prepare=None) -> DataFrame:
    """One row per document: doc_id, n_runs, start, length, period, exponent_milli of its run with
    the greatest exponent (null without one), runs (a line `start,length,period` each) and the
    collapsed text, its words joined by one blank.

    `prepare(doc_id, words)` may give other words to look at.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            words = [text.split() for text in as_bytes(batch)]
            if prepare is not None:
                words = [prepare(i, w) for i, w in zip(ids, words, strict=True)]
            all_runs = runs(_numbers().of(words))
            best = [longest(r) for r in all_runs]
            columns = [pa.array([None if b is None else b[k] for b in best], pa.int64())
                       for k in range(3)]
            milli = pa.array([None if b is None else 1000 * b[1] // b[2] for b in best], pa.int64())
            texts = [b" ".join(collapsed(w, r)) for w, r in zip(words, all_runs, strict=True)]
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in r) for r in all_runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in all_runs], pa.int64()), *columns,
                 milli, pa.array(lines),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_map(rows, found, "doc_id bigint, n_runs bigint, start bigint, length bigint, "
                     "period bigint, exponent_milli bigint, runs string, collapsed string")
