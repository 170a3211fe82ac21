"""Top-N per window, and the ordered, limited read of a ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream import constants as C

def top_n_per_window(totals: DataFrame, key: str, n: int = C.TOP_N,
                     salts: int = 1) -> DataFrame:
    """Rank keys by total within each window, keep ranks 1..n; ties go to the smaller key.

    For n up to `spark.sql.optimizer.windowGroupLimitThreshold` the planner cuts every map
    partition to its own n best rows per window before the shuffle, so a window with millions of
    keys costs its reducer only n rows per map task. For larger n, `salts` deals a window's keys
    to so many tasks first, each of which keeps its n best; nothing is lost, since a row among the n
    best of a window is among the n best of its salt.
    """
    order = [F.desc("total_sales"), F.asc(key)]
    if salts > 1:
        salted = Window.partitionBy(
            "window_start", F.pmod(F.xxhash64(key), F.lit(salts))).orderBy(*order)
        totals = (
            totals.withColumn("salted_rank", F.row_number().over(salted))
            .where(F.col("salted_rank") <= n)
            .drop("salted_rank")
        )
    best_first = Window.partitionBy("window_start").orderBy(*order)
    return totals.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def clamp_limit(limit: int) -> int:
    """The limit that a serving read grants."""
    return max(C.MIN_LIMIT, min(C.MAX_LIMIT, limit))


def by_rank(rankings: DataFrame, limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    """The first `limit` rows by rank, as a distributed top-k."""
    return rankings.orderBy("rank").limit(limit)
