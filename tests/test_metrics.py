"""Metric operators against brute force."""

import random
from datetime import datetime, timedelta

import pytest

from tillstream.operators import metrics

START = datetime(2024, 1, 1)
SCHEMA = "series string, seq long, ts timestamp, value double"


def random_samples(seed, n=400, spread=4000, hot=0.5):
    """Samples with ties, gaps, resets, times before the epoch, and one series with half of all."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        series = "hot" if rng.random() < hot else rng.choice("abc")
        at = START if seed % 2 else datetime(1969, 12, 31, 23, 30)
        at += timedelta(seconds=rng.randrange(spread) // rng.choice((1, 7)) , microseconds=0)
        rows.append((series, i, at, float(rng.randrange(50))))
    return rows


def by_series(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[1])):
        groups.setdefault(row[0], []).append(row)
    return groups


def brute_rate(rows, seconds):
    out = {}
    for series, ordered in by_series(rows).items():
        for _, seq, at, _ in ordered:
            inside = [r for r in ordered if at - timedelta(seconds=seconds) <= r[2] <= at]
            increase = 0.0
            for a, b in zip(inside, inside[1:]):
                increase += b[3] if b[3] < a[3] else b[3] - a[3]
            elapsed = (inside[-1][2] - inside[0][2]).total_seconds()
            out[series, seq] = (increase, increase / elapsed if elapsed > 0 else None)
    return out


@pytest.mark.parametrize("seed, seconds", [(1, 60), (2, 60), (3, 300), (4, 5000), (5, 1)])
def test_counter_rate(spark, seed, seconds):
    rows = random_samples(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    rated = metrics.counter_rate(frame, "series", seconds, seq="seq")
    assert rated.columns == ["series", "seq", "ts", "value", "increase", "rate"]
    got = {(r.series, r.seq): (r.increase, r.rate) for r in rated.collect()}
    assert got == brute_rate(rows, seconds)


def test_counter_rate_keeps_a_series_without_name(spark):
    rows = [(None, i, START + timedelta(seconds=i), float(i)) for i in range(5)]
    rated = metrics.counter_rate(spark.createDataFrame(rows, SCHEMA), "series", 60, seq="seq")
    assert sorted(r.increase for r in rated.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_counter_rate_never_shuffles_on_series_alone(spark, plan_of):
    frame = spark.createDataFrame(random_samples(1), SCHEMA)
    plan = plan_of(metrics.counter_rate(frame, "series", 60, seq="seq"))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and all(", slice#" in line or ", stretch#" in line for line in shuffles)


def brute_breaches(rows, bound, seconds):
    out = []
    for series, ordered in by_series(rows).items():
        run = []
        for row in [*ordered, None]:
            if row is not None and row[3] > bound:
                run.append(row)
                continue
            if run and (run[-1][2] - run[0][2]).total_seconds() >= seconds:
                out.append((series, run[0][2], run[-1][2], len(run),
                            (run[-1][2] - run[0][2]).total_seconds()))
            run = []
    return sorted(out)


@pytest.mark.parametrize("seed, bound, seconds, size", [
    (1, 10, 60, 3600), (2, 10, 60, 100), (3, 5, 0, 7), (4, -1, 0, 60), (5, 25, 30, 600),
    (6, 49, 0, 60), (7, 2, 300, 50)])
def test_sustained_breaches(spark, seed, bound, seconds, size):
    rows = random_samples(seed)
    found = metrics.sustained_breaches(
        spark.createDataFrame(rows, SCHEMA), "series", bound, seconds, seq="seq",
        slice_seconds=size)
    got = sorted((r.series, r.breach_start.replace(tzinfo=None), r.breach_end.replace(tzinfo=None),
                  r.samples, r.duration_seconds) for r in found.collect())
    assert got == brute_breaches(rows, bound, seconds)


def test_missing_value_ends_a_breach(spark):
    rows = [("a", i, START + timedelta(minutes=i), None if i == 2 else 9.0) for i in range(5)]
    found = metrics.sustained_breaches(
        spark.createDataFrame(rows, SCHEMA), "series", 1, 0, seq="seq").collect()
    assert sorted(r.samples for r in found) == [2, 2]


def quantile(spark, buckets, q):
    rows = [("g", float(le), n) for le, n in buckets]
    frame = spark.createDataFrame(rows, "g string, le double, cumulative long")
    return metrics.histogram_quantile(frame, "g", q).first().quantile_value


@pytest.mark.parametrize("buckets, q, expected", [
    ([(1, 0), (2, 10), ("inf", 10)], 0.5, 1.5),
    ([(1, 10), (2, 10), ("inf", 10)], 0.5, 0.5),
    ([(1, 5), (2, 5), (4, 10), ("inf", 10)], 0.75, 3.0),
    ([(1, 5), (2, 5), ("inf", 10)], 0.95, 2.0),
    ([(-1, 5), (2, 10), ("inf", 10)], 0.25, -1.0),
    ([(1, 0), ("inf", 0)], 0.5, None),
    ([("inf", 5)], 0.5, None),
    ([(1, 5), (2, 10)], 0.5, None),
    ([(1, 2), (1, 3), ("inf", 2), ("inf", 3)], 0.5, 0.5),
])
def test_histogram_quantile(spark, buckets, q, expected):
    assert quantile(spark, buckets, q) == expected


def test_labels_match_as_a_whole(spark):
    frame = spark.createDataFrame([("500",), ("503",), ("5000",), ("1500",), ("200",), ("50\n",)],
                                  "status string")
    kept = metrics.matching_series(frame, "status", "5..").collect()
    assert sorted(r.status for r in kept) == ["500", "503"]
    either = metrics.matching_series(frame, "status", "500|200").collect()
    assert sorted(r.status for r in either) == ["200", "500"]


def test_latest_gauge_breaks_ties(spark, plan_of):
    samples = random_samples(1)
    frame = spark.createDataFrame(samples, SCHEMA)
    newest = metrics.latest_gauge(frame, "series", seq="seq")
    assert "partial_max" in plan_of(newest)
    for row in newest.collect():
        last = by_series(samples)[row.series][-1]
        assert (row.ts.replace(tzinfo=None), row.value) == (last[2], last[3])
    turned = spark.createDataFrame(samples[::-1], SCHEMA).coalesce(1)
    assert set(metrics.latest_gauge(turned, "series").collect()) == set(
        metrics.latest_gauge(frame, "series").collect())
