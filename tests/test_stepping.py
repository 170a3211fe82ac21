"""Metrics on a grid of steps, against brute force."""

from datetime import datetime, timedelta, timezone

import pytest

from test_metrics import SCHEMA, by_series, random_samples
from tillstream.operators import stepping

MICROS = 1_000_000


def micros(at):
    return int(at.replace(tzinfo=timezone.utc).timestamp() * MICROS)


def moments(grid):
    return [grid.start + k * grid.step for k in range(grid.last + 1)]


def plain_rate(inside, t, seconds):
    """Increase and stretched rate of samples (micros, value) in order."""
    increase = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in zip(inside, inside[1:], strict=False))
    covered = (inside[-1][0] - inside[0][0]) / MICROS
    if not covered:
        return increase, None
    mean = covered / (len(inside) - 1)
    ahead = (inside[0][0] - t + seconds * MICROS) / MICROS
    behind = (t - inside[-1][0]) / MICROS
    ahead, behind = (mean / 2 if gap >= mean * 1.1 else gap for gap in (ahead, behind))
    if increase > 0 and inside[0][1] >= 0:
        ahead = min(ahead, covered * (inside[0][1] / increase))
    return increase, increase * ((covered + ahead + behind) / covered) / seconds


@pytest.mark.parametrize("seed,step,seconds", [(1, 60, 300), (2, 60, 90), (3, 300, 60), (4, 45, 120)])
def test_rates_equal_brute_force(spark, seed, step, seconds):
    rows = random_samples(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    grid = stepping.Grid.over(frame, step)
    found = {(r.series, micros(r.ts)): (r.increase, r.rate) for r in stepping.rate_at_steps(
        frame, "series", grid, seconds, seq="seq").collect()}
    want = {}
    for series, ordered in by_series(rows).items():
        for t in moments(grid):
            inside = [(micros(r[2]), r[3]) for r in ordered if t - seconds * MICROS < micros(r[2]) <= t]
            if len(inside) > 1:
                want[series, t] = plain_rate(inside, t, seconds)
    assert found.keys() == want.keys() and want
    for key, (increase, rate) in want.items():
        assert found[key][0] == increase
        assert found[key][1] == (None if rate is None else pytest.approx(rate, rel=1e-12))


@pytest.mark.parametrize("seed,step,lookback", [(1, 60, 300), (2, 60, 10), (3, 7, 30)])
def test_values_equal_brute_force(spark, seed, step, lookback):
    rows = random_samples(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    grid = stepping.Grid.over(frame, step)
    found = {(r.series, micros(r.ts)): r.value for r in stepping.value_at_steps(
        frame, "series", grid, lookback, seq="seq").collect()}
    want = {}
    for series, ordered in by_series(rows).items():
        for t in moments(grid):
            inside = [r for r in ordered if t - lookback * MICROS < micros(r[2]) <= t]
            if inside:
                want[series, t] = inside[-1][3]
    assert found == want


def test_a_gap_ends_a_stretch(spark):
    start = datetime(2024, 1, 1, 12)
    steps = [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13]
    rows = [("a", start + timedelta(minutes=k), 5.0) for k in steps]
    rows += [("b", start + timedelta(minutes=k), 5.0 if k != 4 else 1.0) for k in range(8)]
    frame = spark.createDataFrame(rows, "series string, ts timestamp, value double")
    grid = stepping.Grid(micros(start), micros(start) + 3600 * MICROS, 60)
    found = [(r.series, r.pending_since.minute, r.firing_since.minute, r.firing_to.minute, r.steps)
             for r in stepping.firing_at_steps(frame, "series", grid, 2, 300).collect()]
    assert sorted(found) == [("a", 0, 5, 5, 6), ("a", 7, 12, 13, 7)]


def test_no_samples(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert stepping.Grid.over(frame, 60) is None
    grid = stepping.Grid(0, 0, 60)
    assert stepping.rate_at_steps(frame, "series", grid, 300).collect() == []
    assert stepping.value_at_steps(frame, "series", grid).collect() == []


def test_series_are_not_sorted_as_a_whole(spark, plan_of):
    """Every window of the plan is by series and slice."""
    frame = spark.createDataFrame(random_samples(1), SCHEMA)
    plan = plan_of(stepping.rate_at_steps(frame, "series", stepping.Grid.over(frame, 60), 300))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("slice" in line for line in windows)
