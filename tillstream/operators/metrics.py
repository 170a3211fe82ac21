"""Operators on metric samples `(series, ts, value)`.

One series may hold any share of all samples, so no operator sorts the samples of a whole series.
Samples are grouped by series and a slice of time; what crosses slices is handled by one row per
slice, and in `counter_rate` by narrow copies of the samples for the slice whose windows begin there. Samples of one series are ordered by `ts`, then by `seq` if given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream import constants as C

_MICROS = 1_000_000
# A second divides into so many whole slices.
_SLICES = 16


def _columns(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _slice_of(micros: Column, length: int) -> Column:
    """Number of the slice of time, rounding down before the epoch too."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(length)), F.lit(length))


def _step(before: Column, value: Column) -> Column:
    """Increase from one sample to the next; a fall is a reset."""
    return (
        F.when(before.isNull(), value - value)
        .when(value < before, value)
        .otherwise(value - before)
    )


def counter_rate(samples: DataFrame, series: Sequence[str] | str, window_seconds: int,
                 ts: str = "ts", value: str = "value", seq: str | None = None) -> DataFrame:
    """Increase and per-second rate of a counter over a trailing window, at every sample.

    The window of a sample at t holds the samples of its series in [t - w, t]. The increase is
    the sum of steps between neighbours in the window; a step down is a reset and counts the
    new value. The rate divides by the time between the first and last of them, without
    stretching to the window bounds, and is NULL with fewer than two distinct times.

    Adds `increase` and `rate`; all other columns stay. A window is as long as `_SLICES` slices of
    time, so it begins in the slice that lies so many before its end. A group is one slice with
    the time and value of the samples of that other one, which each sample is copied to; what lies
    between comes from one row per slice. One shuffle of the samples and their narrow copies.
    """
    # As a struct, a series without a name joins like any other.
    by = ["key"]
    length = window_seconds * _MICROS
    width = length // _SLICES
    tie = F.col(seq) if seq else F.lit(0)
    at = F.unix_micros(F.col(ts))
    row = F.struct(*samples.columns)
    placed = samples.select(
        F.struct(*_columns(series)).alias("key"), F.col(value).alias("v"), at.alias("at_us"), tie.alias("tie"), F.explode(F.array(
            F.struct(_slice_of(at, width).alias("slice"), F.lit(True).alias("is_own"),
                     row.alias("row")),
            F.struct((_slice_of(at, width) + _SLICES).alias("slice"), F.lit(False).alias("is_own"),
                     F.when(F.lit(False), row).alias("row")))).alias("to"),
    ).select(*by, "v", "at_us", "tie", "to.*").repartition(*by, "slice")
    # Dealt by series and slice, it serves the windows over parts of a slice as well.

    # Running sums of the steps in each slice, 0 at its first sample.
    part = Window.partitionBy(*by, "slice", "is_own")
    in_order = part.orderBy("at_us", "tie")
    summed = placed.withColumn("step", _step(F.lag("v").over(in_order), F.col("v"))).withColumns({
        "sum_here": F.sum("step").over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "sum_at": F.sum("step").over(
            part.orderBy("at_us").rangeBetween(Window.unboundedPreceding, Window.currentRow))})

    # Each sample asks, at the start of its window, for the first sample from there on. Walking
    # back in time, that is the last copy passed before the question.
    back = (
        Window.partitionBy(*by, "slice")
        .orderBy(F.desc("walk_us"), F.asc("is_own"), F.desc("tie"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    copy = F.when(~F.col("is_own"), F.struct("at_us", "sum_here"))
    asked = (
        summed.withColumn("walk_us", F.when(
            F.col("is_own"), F.col("at_us") - length).otherwise(F.col("at_us")))
        .withColumn("first", F.last(copy, ignorenulls=True).over(back))
        .where("is_own")
    )
    asked = asked.join(_between_slices(summed.where("is_own"), by), [*by, "slice"])
    # Without one, the window's first sample is the first of a later slice, its own at the latest.
    found = F.col("first").isNotNull()
    increase = F.col("sum_at") + F.when(
        found, F.col("since_start") - F.col("first.sum_here")).otherwise(F.col("since_next"))
    elapsed = (F.col("at_us") - F.when(found, F.col("first.at_us")).otherwise(F.col("next_us"))) / _MICROS
    return asked.select(
        "row.*", increase.alias("increase"),
        F.when(elapsed > 0, increase.cast("double") / elapsed).alias("rate"))


def _between_slices(own: DataFrame, by: list[str]) -> DataFrame:
    """Per slice, up to its first sample: the increase since the first sample of the slice
    `_SLICES` before (`since_start`), and since the first sample behind that slice (`since_next`),
    which is at `next_us`.

    Slices are put in order in stretches of `_SLICES`, each with a copy of the stretch before.
    """
    order = F.struct("at_us", "tie")
    slices = own.groupBy(*by, "slice").agg(
        F.min("at_us").alias("first_us"), F.min_by("v", order).alias("first_v"),
        F.max_by("v", order).alias("last_v"), F.sum("step").alias("inner"))
    stretch = _slice_of(F.col("slice"), _SLICES)
    copied = slices.withColumn("stretch", F.explode(F.array(stretch, stretch + 1)))
    in_time = Window.partitionBy(*by, "stretch").orderBy("slice")
    gained = (F.coalesce(F.lag("inner").over(in_time), F.lit(0))
              + F.coalesce(_step(F.lag("last_v").over(in_time), F.col("first_v")), F.lit(0)))
    upto = copied.withColumn("gained", gained).withColumn("sum_first", F.sum("gained").over(
        in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (
        upto.withColumns({
            "start": F.first("sum_first").over(in_time.rangeBetween(-_SLICES, -_SLICES)),
            "next": F.first(F.struct("first_us", "sum_first")).over(
                in_time.rangeBetween(1 - _SLICES, 0))})
        .where(F.col("stretch") == stretch)
        .select(*by, "slice", (F.col("sum_first") - F.col("start")).alias("since_start"),
                (F.col("sum_first") - F.col("next.sum_first")).alias("since_next"),
                F.col("next.first_us").alias("next_us"))
    )


def cumulative_buckets(values: DataFrame, by: Sequence[str] | str, value: str,
                       bounds: Sequence[float]) -> DataFrame:
    """Cumulative histogram `(by, le, cumulative)` with a last bucket of +Infinity.

    One aggregation with a counter per bound; only the finished counters are unfolded.
    """
    keys = _columns(by)
    counted = values.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= F.lit(bound)).alias(f"le_{i}")
          for i, bound in enumerate(bounds)],
        F.count(F.col(value)).alias("le_all"),
    )
    entries = [
        F.struct(F.lit(float(bound)).alias("le"), F.col(f"le_{i}").alias("cumulative"))
        for i, bound in enumerate(bounds)
    ]
    entries.append(F.struct(
        F.lit(float("inf")).alias("le"), F.col("le_all").alias("cumulative")))
    return counted.select(*keys, F.inline(F.array(*entries)))


def histogram_quantile(buckets: DataFrame, by: Sequence[str] | str,
                       quantile: float = C.LATENCY_QUANTILE,
                       cumulative: str = "cumulative") -> DataFrame:
    """Quantile per group from cumulative buckets `(le, cumulative)`, linear within a bucket.

    The wanted rank is `quantile * total`. The first bucket whose count reaches it is cut
    linearly from the bucket below (from 0 for the first bucket with a positive bound). If
    that is the last, unbounded bucket, the answer is the highest finite bound; an empty
    histogram gives NULL. Counts of equal `(group, le)` are added up first, so a group holds
    as many rows as there are bounds.
    """
    keys = _columns(by)
    merged = buckets.groupBy(*keys, "le").agg(F.sum(cumulative).alias("reached"))
    bound_order = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    infinite = F.col("le") == F.lit(float("inf"))
    placed = (
        merged
        .withColumn("below", F.coalesce(F.lag("reached").over(bound_order), F.lit(0)))
        .withColumn("lower", F.lag("le").over(bound_order))
        .withColumn("total", F.max(F.when(infinite, F.col("reached"))).over(whole))
    )
    wanted = F.lit(quantile) * F.col("total")
    share = (wanted - F.col("below")) / (F.col("reached") - F.col("below"))
    start = F.coalesce("lower", F.lit(0.0))
    cut = (
        F.when(infinite, F.col("lower"))
        .when(F.col("lower").isNull() & (F.col("le") <= 0), F.col("le"))
        .when(F.col("reached") == F.col("below"), F.col("le"))
        .otherwise(start + (F.col("le") - start) * share)
    )
    reaches = (F.col("reached") >= wanted) & (F.col("total") > 0)
    return placed.groupBy(*keys).agg(
        F.min_by(cut, F.when(reaches, F.col("le"))).alias("quantile_value"))


def sustained_breaches(samples: DataFrame, series: Sequence[str] | str, bound: float,
                       min_seconds: int, ts: str = "ts", value: str = "value",
                       seq: str | None = None, slice_seconds: int = 3600) -> DataFrame:
    """Stretches of a series above `bound` without a break for at least `min_seconds`.

    Returns `(series, breach_start, breach_end, samples, duration_seconds)`, where the
    duration runs from the first to the last sample above the bound.

    Runs are first found within slices of time. Only the first and last run of a slice can
    continue elsewhere. So a slice becomes one row, with those two and the inner runs that last long
    enough, and only these rows are put in order per series. The samples are read once.
    """
    by = _columns(series)
    tie = F.col(seq) if seq else F.lit(0)
    micros = F.unix_micros(F.col(ts))
    above = F.coalesce(F.col(value) > F.lit(bound), F.lit(False))
    sliced = samples.select(
        *by, F.col(ts).alias("at"), tie.alias("tie"), above.alias("above"),
        _slice_of(micros, slice_seconds * _MICROS).alias("slice"),
    )
    group = Window.partitionBy(*by, "slice")
    in_order = group.orderBy("at", "tie")
    changed = (F.col("above") != F.lag("above").over(in_order)).cast("bigint")
    run = F.sum(F.coalesce(changed, F.lit(0))).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = F.struct("run", "above", "start", "end", "samples")
    lasted = (F.unix_micros("end") - F.unix_micros("start")) / _MICROS
    runs = (
        sliced.withColumn("run", run)
        .groupBy(*by, "slice", "run")
        .agg(F.first("above").alias("above"), F.min("at").alias("start"),
             F.max("at").alias("end"), F.count(F.lit(1)).alias("samples"))
        .withColumn("last_run", F.max("run").over(group))
        .withColumn("inner", F.col("run").between(1, F.col("last_run") - 1))
    )
    slices = runs.groupBy(*by, "slice").agg(
        F.first("last_run").alias("last_run"),
        F.min_by(found, "run").alias("opening"), F.max_by(found, "run").alias("closing"),
        F.collect_list(F.when(F.col("inner") & F.col("above") & (lasted >= min_seconds), found))
        .alias("inner"))

    # The opening run goes on from the slice before if both are above. Stretches are numbered;
    # a closing run that isn't also the opening one begins a new one.
    in_time = Window.partitionBy(*by).orderBy("slice")
    continues = F.col("opening.above") & F.coalesce(F.lag("closing.above").over(in_time), F.lit(False))
    two = (F.col("last_run") > 0).cast("bigint")
    numbered = (
        slices.withColumn("begun", F.when(continues, two).otherwise(two + 1))
        .withColumn("stretch", F.sum("begun").over(
            in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )

    def entry(run: Column, stretch: Column, own: Column) -> Column:
        return F.struct(stretch.alias("stretch"), own.alias("own"), run.alias("found"))

    # An inner run is a stretch of its own, told by its place in its slice.
    none = F.lit(None).cast("bigint")
    opening = entry(F.col("opening"), F.col("stretch") - two, none)
    closing = F.when(F.col("last_run") > 0, entry(F.col("closing"), F.col("stretch"), none))
    inner = F.transform("inner", lambda one: entry(one, F.col("slice"), one["run"]))
    merged = (
        numbered.select(*by, F.inline(F.concat(F.array(opening, closing), inner)))
        .where("found.above")
        .groupBy(*by, "stretch", "own")
        .agg(F.min("found.start").alias("start"), F.max("found.end").alias("end"),
             F.sum("found.samples").alias("samples"))
    )
    return (
        merged.select(*by, F.col("start").alias("breach_start"), F.col("end").alias("breach_end"),
                      "samples", lasted.alias("duration_seconds"))
        .where(F.col("duration_seconds") >= min_seconds)
    )


def latest_gauge(samples: DataFrame, series: Sequence[str] | str, ts: str = "ts",
                 value: str = "value", seq: str | None = None) -> DataFrame:
    """Newest value per series; among samples of one time that of the highest `seq`, else of the
    largest value. Partly aggregated before the shuffle: one row per series and map task."""
    newest = samples.groupBy(*_columns(series)).agg(
        F.max(F.struct(F.col(ts).alias("ts"), F.col(seq or value).alias("tie"),
                       F.col(value).alias("value"))).alias("newest"))
    return newest.select(*_columns(series), "newest.ts", "newest.value")


def matching_series(samples: DataFrame, label: str, pattern: str) -> DataFrame:
    """Samples whose label matches the whole pattern."""
    return samples.where(F.col(label).rlike(rf"^(?:{pattern})\z"))


def error_rate(samples: DataFrame, series: Sequence[str] | str, window_seconds: int = 300,
               status: str = "status", pattern: str = C.ERROR_STATUS_PATTERN,
               ts: str = "ts", value: str = "value", seq: str | None = None) -> DataFrame:
    """`counter_rate` of the series whose status label is an error; filters before the shuffle."""
    return counter_rate(
        matching_series(samples, status, pattern), series, window_seconds, ts, value, seq)

