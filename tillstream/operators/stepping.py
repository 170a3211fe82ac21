"""Evaluation of metric samples on a grid of steps, as a scraper's rules and dashboards do it.

Step k is at `start + k * step`. A series has a value at a step if it has a sample in the `lookback` up to it,
and a rate if it has two or more within the range up to it; both intervals leave out their beginning. Rates
are stretched to the bounds of the range where samples come close to them.

One series may hold any share of the samples. They are first reduced to one row per series and slice of
the grid; only such rows are handed to all the steps they matter to, which are as many as fit the lookback
or the range. No series is put in order as a whole. Times are whole microseconds, steps whole seconds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.operators.metrics import histogram_quantile, sustained_breaches

_MICROS = 1_000_000
LOOKBACK_SECONDS = 300
# Samples farther than so many of their mean distances from a bound don't reach up to it.
REACH = 1.1


@dataclass(frozen=True)
class Grid:
    """Steps from `start` to `end` (included if it is one), in microseconds from 1970."""

    start: int
    end: int
    seconds: int

    @classmethod
    def over(cls, samples: DataFrame, seconds: int, ts: str = "ts") -> Grid | None:
        """All full steps from the first sample to the last one; None without samples."""
        at, step = F.unix_micros(F.col(ts)), seconds * _MICROS
        first, last = samples.agg(F.min(at), F.max(at)).first()
        return None if first is None else cls(first // step * step, last // step * step, seconds)

    @property
    def step(self) -> int:
        return self.seconds * _MICROS

    @property
    def last(self) -> int:
        return (self.end - self.start) // self.step

    def at(self, number: Column) -> Column:
        return F.timestamp_micros(F.lit(self.start) + number * self.step)


def _columns(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _ceil_div(value: Column, length: int) -> Column:
    return -F.call_function("div", -value - F.pmod(-value, F.lit(length)), F.lit(length))


def _floor_div(value: Column, length: int) -> Column:
    return F.call_function("div", value - F.pmod(value, F.lit(length)), F.lit(length))


def _at_each(rows: DataFrame, first: Column, last: Column, grid: Grid) -> DataFrame:
    """A copy of each row for every step from `first` to `last` on the grid, its number in `k`."""
    rows = rows.withColumns({"first_k": F.greatest(first, F.lit(0)),
                             "last_k": F.least(last, F.lit(grid.last))})
    return (rows.where("first_k <= last_k")
            .withColumn("k", F.explode(F.sequence("first_k", "last_k"))).drop("first_k", "last_k"))


def value_at_steps(samples: DataFrame, series: Sequence[str] | str, grid: Grid,
                   lookback_seconds: int = LOOKBACK_SECONDS, ts: str = "ts", value: str = "value",
                   seq: str | None = None) -> DataFrame:
    """(series, ts, value): at every step the newest sample of the lookback; of equal times the one with
    the highest `seq`, else the largest. Nothing for a step without one."""
    by, since = _columns(series), F.col("newest.at") - grid.start
    newest = samples.select(
        *by, F.struct(F.unix_micros(F.col(ts)).alias("at"), F.col(seq or value).alias("tie"),
                      F.col(value).alias("value")).alias("newest"))
    # Of the samples that come between two steps only the newest can be seen.
    newest = newest.groupBy(*by, _ceil_div(since, grid.step).alias("seen_from")).agg(
        F.max("newest").alias("newest"))
    seen_to = _ceil_div(since + lookback_seconds * _MICROS, grid.step) - 1
    at_steps = _at_each(newest, F.col("seen_from"), seen_to, grid)
    found = at_steps.groupBy(*by, "k").agg(F.max("newest").alias("newest"))
    return found.select(*by, grid.at(F.col("k")).alias("ts"), F.col("newest.value").alias("value"))


def rate_at_steps(samples: DataFrame, series: Sequence[str] | str, grid: Grid, range_seconds: int,
                  ts: str = "ts", value: str = "value", seq: str | None = None) -> DataFrame:
    """(series, ts, increase, rate) of a counter at every step, from the samples of the range up to it.

    The increase counts a fall as a reset. The rate is the increase, stretched from the time between the
    first and last sample to the range: up to a bound that is no farther than `REACH` mean distances, by
    half a mean distance otherwise, and never beyond where the counter would have been zero. Null if all
    samples are at one time; nothing for a step with fewer than two samples.

    Slices are as long as the greatest common divisor of step and range; a range has `range / slice` of
    them.
    """
    by, slice_seconds = _columns(series), gcd(grid.seconds, range_seconds)
    width, slices = slice_seconds * _MICROS, range_seconds // slice_seconds
    placed = samples.select(
        *by, F.unix_micros(F.col(ts)).alias("at"), (F.col(seq) if seq else F.lit(0)).alias("tie"),
        F.col(value).cast("double").alias("v"))
    placed = placed.withColumn("slice", _ceil_div(F.col("at") - grid.start, width))
    before = F.lag("v").over(Window.partitionBy(*by, "slice").orderBy("at", "tie"))
    order = F.struct("at", "tie")
    part = placed.withColumn("step", _grown(before, F.col("v"))).groupBy(*by, "slice").agg(
        F.min("at").alias("first_at"), F.min_by("v", order).alias("first_v"),
        F.max("at").alias("last_at"), F.max_by("v", order).alias("last_v"),
        F.sum("step").alias("grown"), F.count(F.lit(1)).alias("n"))
    per_step = grid.seconds // slice_seconds
    at_steps = _at_each(part, _ceil_div(F.col("slice"), per_step),
                        _floor_div(F.col("slice") + slices - 1, per_step), grid)
    # As many rows as a range has slices.
    rows = at_steps.groupBy(*by, "k").agg(F.sort_array(F.collect_list(F.struct(
        "slice", "first_at", "first_v", "last_at", "last_v", "grown", "n"))).alias("parts"))
    between = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda i: _grown(
        F.get("parts", i - 1)["last_v"], F.get("parts", i)["first_v"]))
    between = F.when(F.size("parts") > 1, between).otherwise(F.array().cast("array<double>"))
    first, last = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    total = F.aggregate(F.concat(F.transform("parts", lambda p: p["grown"]), between),
                        F.lit(0.0), lambda a, b: a + b)
    found = rows.select(
        *by, "k", total.alias("increase"), first["first_v"].alias("first_v"),
        first["first_at"].alias("first_at"), last["last_at"].alias("last_at"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["n"]).alias("n"))
    return _stretched(found.where("n > 1"), grid, range_seconds).select(
        *by, grid.at(F.col("k")).alias("ts"), "increase", "rate")


def _grown(before: Column, value: Column) -> Column:
    return (F.when(before.isNull(), F.lit(0.0)).when(value < before, value)
            .otherwise(value - before))


def _stretched(found: DataFrame, grid: Grid, range_seconds: int) -> DataFrame:
    """Adds `rate`."""
    at = F.lit(grid.start) + F.col("k") * grid.step
    found = found.withColumns({
        "covered": (F.col("last_at") - F.col("first_at")) / _MICROS,
        "ahead": (F.col("first_at") - at + range_seconds * _MICROS) / _MICROS,
        "behind": (at - F.col("last_at")) / _MICROS})
    found = found.withColumn("distance", F.col("covered") / (F.col("n") - 1))

    def reached(gap: str) -> Column:
        far = F.col(gap) >= F.col("distance") * REACH
        return F.when(far, F.col("distance") / 2).otherwise(F.col(gap))

    found = found.withColumns({"ahead": reached("ahead"), "behind": reached("behind")})
    to_zero = F.col("covered") * (F.col("first_v") / F.col("increase"))
    ahead = F.when((F.col("increase") > 0) & (F.col("first_v") >= 0) & (to_zero < F.col("ahead")),
                   to_zero).otherwise(F.col("ahead"))
    stretched = F.col("increase") * ((F.col("covered") + ahead + F.col("behind")) / F.col("covered"))
    return found.withColumn("rate", F.when(F.col("covered") > 0, stretched / range_seconds))


def firing_at_steps(values: DataFrame, series: Sequence[str] | str, grid: Grid, bound: float,
                    for_seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """Stretches of consecutive steps with a value above `bound`, from the step at which they have lasted
    for `for_seconds`: (series, pending_since, firing_since, firing_to, steps). A step without a value ends
    a stretch."""
    by = _columns(series)
    rows = values.select(*by, F.unix_micros(F.col(ts)).alias("at"), F.col(value).alias("v"))
    # A step behind a value, with none of its own, is a gap.
    gaps = rows.select(*by, (F.col("at") + grid.step).alias("at"), F.lit(None).cast("double").alias("v"))
    dense = rows.unionByName(gaps).groupBy(*by, "at").agg(F.max("v").alias("v"))
    dense = dense.select(*by, F.timestamp_micros("at").alias("ts"), "v")
    found = sustained_breaches(dense, by, bound, for_seconds, value="v")
    return found.select(
        *by, F.col("breach_start").alias("pending_since"),
        F.timestamp_micros(F.unix_micros("breach_start") + for_seconds * _MICROS).alias("firing_since"),
        F.col("breach_end").alias("firing_to"), F.col("samples").alias("steps"))


def latency_alert(buckets: DataFrame, series: Sequence[str] | str, grid: Grid, seq: str | None = None,
                  rule: tuple[float, int] = C.LATENCY_P95_RULE,
                  range_seconds: int = C.LATENCY_RATE_SECONDS, ts: str = "ts",
                  value: str = "value") -> DataFrame:
    """The latency rule on a grid: the 95th percentile over the rates of cumulative bucket counters
    `(series, le)`, above its bound for five minutes of steps."""
    by = _columns(series)
    rates = rate_at_steps(buckets, [*by, "le"], grid, range_seconds, ts, value, seq)
    p95 = histogram_quantile(rates.where("rate is not null"), [*by, "ts"], C.LATENCY_QUANTILE, "rate")
    return firing_at_steps(p95, by, grid, *rule, value="quantile_value")
