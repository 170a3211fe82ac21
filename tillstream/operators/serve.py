"""Reads of a ranking table: latest version per key, latest window, given window, response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.functions.times import format_response_time
from tillstream.operators.rank import by_rank, clamp_limit

RANKING_KEY = ("window_start", "rank")
RANKING_VERSION = ("updated_at", "batch_id")


def latest_by_key(log: DataFrame, keys: Sequence[str] = RANKING_KEY,
                  version: Sequence[str] = RANKING_VERSION) -> DataFrame:
    """Keep the newest row per key; on equal versions the later insert.

    The filter on row number 1 lets the planner drop all but one row per key in each map
    partition before the shuffle. Filters on the keys pass below it down to the scan.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(column) for column in version])
    return (
        log.withColumn("newest", F.row_number().over(newest_first))
        .where(F.col("newest") == 1)
        .drop("newest")
    )


def latest_windows(log: DataFrame, version: Sequence[str] = RANKING_VERSION) -> DataFrame:
    """Keep the newest version of each window as a whole.

    Unlike `latest_by_key`, ranks that only an older version has are gone too, so a key can't stand
    at two ranks. A window has few rows, those of its rankings.
    """
    newest = F.max(F.struct(*version)).over(Window.partitionBy("window_start"))
    return (
        log.withColumn("newest", newest)
        .where(F.struct(*version).eqNullSafe(F.col("newest")))
        .drop("newest")
    )


def window_of_text(text: str) -> Column:
    """Timestamp of a window given as text, fails on text that is none.

    Takes ISO and blank-separated date-times with or without zone, epoch seconds (9 or 10
    digits), and `yyyyMMdd` with or without `HHmmss`.
    """
    bare = text.strip()
    if bare.isdigit():
        if len(bare) in (9, 10):
            return F.timestamp_seconds(F.lit(int(bare)))
        if len(bare) in (8, 14):
            return F.to_timestamp(F.lit(bare), "yyyyMMddHHmmss"[:len(bare)])
    return F.to_timestamp(F.lit(bare))


def _of_country(rankings: DataFrame, country: str | None) -> DataFrame:
    # Exact match, unlike the filter before ranking. After `latest_by_key`, because the key
    # has no country: a newer row of another country replaces an older one.
    return rankings if country is None else rankings.where(F.col("country") == country)


def _on_date_of(log: DataFrame, window_start: Column) -> DataFrame:
    """Read only the date partition of a window, where the table has one."""
    if "window_date" not in log.columns:
        return log
    return log.where(F.col("window_date") == F.to_date(window_start))


def _newest_start(log: DataFrame) -> Column:
    """Start of the newest window; read from the newest date, where the table has dates."""
    if "window_date" in log.columns:
        log = log.where(F.col("window_date") == log.agg(F.max("window_date")).scalar())
    return log.agg(F.max("window_start")).scalar()


def _newest_start_of(log: DataFrame, country: str) -> Column:
    """Start of the newest window in which a row of the country is still the newest of its key.

    Dates are gone through from the newest on, 1, 2, 4, ... at once, until one has such a row: as a
    rule a single date is read. Dates come from the folders; one list of them is all that
    the driver gets.
    """
    def newest(part: DataFrame) -> DataFrame:
        return _of_country(latest_by_key(part), country).agg(
            F.max("window_start").alias("newest_start"))

    if "window_date" not in log.columns:
        return newest(log).scalar()
    dates = sorted((row[0] for row in log.select("window_date").distinct().collect()
                    if row[0] is not None), reverse=True)
    width = 1
    while dates:
        some, dates, width = dates[:width], dates[width:], 2 * width
        between = F.col("window_date").between(F.lit(some[-1]), F.lit(some[0]))
        start = newest(log.where(between)).select(F.unix_micros("newest_start")).first()[0]
        if start is not None:
            return F.timestamp_micros(F.lit(start))
    return F.lit(None).cast("timestamp")


def latest_rankings(log: DataFrame, country: str | None = None,
                    limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    """Rows of the newest window, by rank.

    Without a country every key of the newest window survives `latest_by_key`, so its start is
    a plain maximum. The start found prunes the scan of the rows to one date.
    """
    newest = _newest_start(log) if country is None else _newest_start_of(log, country)
    rows = latest_by_key(_on_date_of(log, newest)).where(F.col("window_start") == newest)
    return by_rank(_of_country(rows, country), clamp_limit(limit))


def rankings_for_window(log: DataFrame, window: str, country: str | None = None,
                        limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    """Rows of the window that starts at the given time, by rank."""
    start = window_of_text(window)
    rows = latest_by_key(_on_date_of(log, start)).where(F.col("window_start") == start)
    return by_rank(_of_country(rows, country), clamp_limit(limit))


def rankings(log: DataFrame, window: str | None = C.LATEST, country: str | None = None,
             limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    """The newest window for `None` or `latest`, else the given one."""
    if window is None or window == C.LATEST:
        return latest_rankings(log, country, limit)
    return rankings_for_window(log, window, country, limit)


def rankings_response(log: DataFrame, key: str, window: str | None = C.LATEST,
                      country: str | None = None, limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    """One row `window{start,end}, rankings[...]`; `N/A` bounds and no entries if none are found.

    At most 100 rows, the largest limit, are gathered into the array.
    """
    names = {"city": "city", "salesman_name": "salesmanName"}
    entry = F.struct(
        F.col("rank"),
        F.col(key).alias(names[key]),
        *([F.col("country")] if country is not None else []),
        F.col("total_sales").alias("totalSales"),
        F.col("transaction_count").alias("transactionCount"),
    )

    def bound(column: str) -> Column:
        return F.coalesce(format_response_time(F.min(column)), F.lit(C.NO_WINDOW))

    return rankings(log, window, country, limit).agg(
        F.struct(bound("window_start").alias("start"), bound("window_end").alias("end"))
        .alias("window"),
        F.array_sort(F.collect_list(entry)).alias("rankings"),
    )


def top_sales_by_city(log: DataFrame, window: str | None = C.LATEST,
                      limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    return rankings_response(log, "city", window, None, limit)


def top_salesmen(log: DataFrame, window: str | None = C.LATEST,
                 country: str = C.RANKED_COUNTRY, limit: int = C.DEFAULT_LIMIT) -> DataFrame:
    return rankings_response(log, "salesman_name", window, country, limit)
