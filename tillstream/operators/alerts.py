"""The alert rules as whole expressions over metric samples `(series, ts, value)`.

Each gives the stretches in which its rule fires: `(series, breach_start, breach_end, samples,
duration_seconds)`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillstream import constants as C
from tillstream.operators.metrics import counter_rate, histogram_quantile, sustained_breaches


def consumer_lag(samples: DataFrame, series: Sequence[str] | str,
                 rule: tuple[float, int] = C.LAG_RULE, **columns: str) -> DataFrame:
    """Lag above its bound for five minutes."""
    return sustained_breaches(samples, series, *rule, **columns)


def checkpoint_time(samples: DataFrame, series: Sequence[str] | str,
                    rule: tuple[float, int] = C.CHECKPOINT_MS_RULE, **columns: str) -> DataFrame:
    """Milliseconds of a checkpoint above their bound for three minutes."""
    return sustained_breaches(samples, series, *rule, **columns)


def latency_p95(buckets: DataFrame, series: Sequence[str] | str, seq: str,
                rule: tuple[float, int] = C.LATENCY_P95_RULE,
                rate_seconds: int = C.LATENCY_RATE_SECONDS, ts: str = "ts",
                value: str = "value") -> DataFrame:
    """The 95th percentile over the rates of cumulative bucket counters, above its bound for five
    minutes.

    `buckets` has a counter per `(series, le)`, all of them read together at every `(ts, seq)`.
    """
    by = [series] if isinstance(series, str) else list(series)
    rated = counter_rate(buckets, [*by, "le"], rate_seconds, ts, value, seq).where(
        "rate is not null")
    p95 = histogram_quantile(rated, [*by, ts, seq], C.LATENCY_QUANTILE, "rate")
    return sustained_breaches(p95, series, *rule, ts=ts, value="quantile_value", seq=seq)
