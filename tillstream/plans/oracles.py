"""SQL twins of the catalogue's queries, written independently of the Spark code."""

from __future__ import annotations

SALES = """
SELECT event_id, user_id, 'E' || event_id AS sale_id, 'user_' || user_id AS salesman_name,
       'city_' || (event_id % 25) AS city,
       CASE event_id % 4 WHEN 0 THEN 'BR' WHEN 1 THEN 'br' WHEN 2 THEN 'AR' ELSE 'US' END AS country,
       CAST(value AS DECIMAL(18,2)) AS amount, event_type AS product, ts AS event_time
FROM events"""

_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_BOUNDS = _TEXT.format("window_start") + ", " + _TEXT.format("window_end")
_ISO_LOCAL = r"regexp_replace(strftime({0}, '%Y-%m-%dT%H:%M:%S.%f'), '(\.000000|000)$', '')"
_CITY = f"{_BOUNDS}, city, total_sales, transaction_count, rank"
_SALESMAN = f"{_BOUNDS}, salesman_name, country, total_sales, transaction_count, rank"


def _country(code: str) -> str:
    return f"upper(country) = '{code}'"


def _totals(key: str, where: str = "true", bucket: str = "date_trunc('hour', event_time)",
            length: str = "1 HOUR") -> str:
    return f"""
SELECT {bucket} AS window_start, {bucket} + INTERVAL {length} AS window_end, {key},
       CAST(sum(amount) AS DECIMAL(28,2)) AS total_sales,
       CAST(count(*) AS BIGINT) AS transaction_count
FROM ({SALES}) WHERE {where} GROUP BY ALL"""


def _ranked(key: str, where: str = "true", country: str | None = None) -> str:
    extra = f", '{country}' AS country" if country else ""
    return f"""
SELECT *{extra} FROM (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY window_start ORDER BY total_sales DESC, {key}) AS INTEGER) AS rank
  FROM ({_totals(key, where)})) WHERE rank <= 10"""


def _closed(ranked: str, newest: str = "SELECT max(ts) FROM events") -> str:
    return f"SELECT * FROM ({ranked}) WHERE window_end <= ({newest}) - INTERVAL 5 SECOND"


def _log(*versions: tuple[str, int]) -> str:
    parts = [
        f"SELECT *, window_end + INTERVAL {seconds} SECOND AS updated_at, {number} AS batch_id"
        f" FROM ({ranked})"
        for number, (ranked, seconds) in enumerate(versions, start=1)
    ]
    return " UNION ALL BY NAME ".join(parts)


def _final(log: str) -> str:
    return f"""
SELECT * EXCLUDE (newest) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY window_start, rank ORDER BY updated_at DESC, batch_id DESC) AS newest
  FROM ({log})) WHERE newest = 1"""


CITY_LOG = _log(
    (_ranked("city"), 5),
    (_ranked("city", _country("BR")), 35),
    (_ranked("city", _country("US")), 35))
SALESMAN_LOG = _log(
    (_ranked("salesman_name", _country("BR"), "BR"), 5),
    (_ranked("salesman_name", _country("AR"), "AR"), 35))


def _newest(final: str, where: str = "true") -> str:
    return f"""
WITH final AS ({final})
SELECT * FROM final
WHERE {where} AND window_start = (SELECT max(window_start) FROM final WHERE {where})
ORDER BY rank LIMIT 10"""


def _window(final: str, where: str = "true") -> str:
    return f"""
SELECT * FROM ({final}) WHERE {where} AND window_start = TIMESTAMP '2024-01-15 12:00:00'
ORDER BY rank LIMIT 10"""


def _response(rows: str, key: str, name: str, with_country: bool = False) -> str:
    iso = "coalesce(strftime(min({0}), '%Y-%m-%dT%H:%M:%SZ'), 'N/A')"
    country = """ || '","country":"' || country""" if with_country else ""
    entry = (
        f"""'{{"rank":' || rank || ',"{name}":"' || {key}{country} || '","totalSales":' """
        f"""|| CAST(total_sales AS VARCHAR) || ',"transactionCount":' || transaction_count || '}}'""")
    return f"""
SELECT '{{"window":{{"start":"' || {iso.format('window_start')} || '","end":"'
       || {iso.format('window_end')} || '"}},"rankings":['
       || coalesce(string_agg({entry}, ',' ORDER BY rank), '') || ']}}' AS response
FROM ({rows})"""


def _events(sale_id: str, ms: str = "epoch_us(event_time) // 1000", source: str = "''",
            rows: str = SALES) -> str:
    return f"""
SELECT {sale_id} AS sale_id, salesman_name, city, country, CAST(amount AS DOUBLE) AS amount,
       product, {ms} AS event_time_ms, {source} AS source
FROM ({rows})"""


_POSTGRES = _events("CAST(event_id + 1 AS VARCHAR)", source="'postgres'")
_FILES = _events("sale_id", source="'files'")
_LEGACY = _events("sale_id", source="'legacy'")

_RELATIONAL = f"""
SELECT event_id + 1 AS id, user_id AS salesman_id, salesman_name AS salesman, city, country,
       CAST(amount AS DECIMAL(12,2)) AS amount, product,
       {_ISO_LOCAL.format('event_time')} || 'Z' AS sale_date,
       {_ISO_LOCAL.format('event_time')} || 'Z' AS created_at
FROM ({SALES})"""

_CSV = f"""
SELECT sale_id, salesman_name, city, country, CAST(amount AS VARCHAR) AS amount, product,
       {_ISO_LOCAL.format('event_time')} AS sale_date
FROM ({SALES})"""

_COUNTER = """
SELECT event_id, event_type AS series, ts, event_id % 500 AS value FROM events"""


def _rate(samples: str, series: str, seconds: int) -> str:
    trailing = (f"(PARTITION BY {series} ORDER BY ts"
                f" RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW)")
    return f"""
WITH stepped AS (
  SELECT *, CASE WHEN lag(value) OVER p IS NULL THEN 0
                 WHEN value < lag(value) OVER p THEN value
                 ELSE value - lag(value) OVER p END AS step
  FROM ({samples}) WINDOW p AS (PARTITION BY {series} ORDER BY ts, event_id)
), framed AS (
  SELECT event_id, {series},
         CAST(sum(step) OVER {trailing} - first_value(step) OVER {trailing} AS BIGINT) AS increase,
         CAST(epoch_us(ts) - first_value(epoch_us(ts)) OVER {trailing} AS DOUBLE) / 1e6 AS elapsed
  FROM stepped)
SELECT event_id, {series}, increase,
       CASE WHEN elapsed > 0 THEN CAST(increase AS DOUBLE) / elapsed END AS rate
FROM framed"""


_BUCKETS = " UNION ALL ".join(
    f"SELECT event_type, CAST('{bound}' AS DOUBLE) AS le,"
    f" CAST(count(*) FILTER (WHERE value <= CAST('{bound}' AS DOUBLE)) AS BIGINT) AS cumulative"
    f" FROM events GROUP BY event_type"
    for bound in ("10", "25", "50", "100", "250", "500", "Infinity"))

_QUANTILE = f"""
WITH placed AS (
  SELECT event_type, le, cumulative AS reached,
         coalesce(lag(cumulative) OVER p, 0) AS below, lag(le) OVER p AS lower,
         CAST('0.95' AS DOUBLE) * CAST(max(cumulative) OVER (PARTITION BY event_type) AS DOUBLE) AS wanted
  FROM ({_BUCKETS}) WINDOW p AS (PARTITION BY event_type ORDER BY le)
), hit AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS nth
  FROM placed WHERE reached >= wanted)
SELECT event_type, CASE WHEN isinf(le) THEN lower
  ELSE coalesce(lower, 0) + (le - coalesce(lower, 0)) * ((wanted - below) / (reached - below)) END
  AS quantile_value
FROM hit WHERE nth = 1"""

_BREACHES = """
WITH marked AS (
  SELECT *, sum(CASE WHEN value > 20 THEN 0 ELSE 1 END) OVER (
    PARTITION BY event_type ORDER BY ts, event_id) AS island
  FROM events
), runs AS (
  SELECT event_type, island, min(ts) AS s, max(ts) AS e, count(*) AS n
  FROM marked WHERE value > 20 GROUP BY ALL)
SELECT event_type, strftime(s, '%Y-%m-%d %H:%M:%S') AS breach_start,
       strftime(e, '%Y-%m-%d %H:%M:%S') AS breach_end, CAST(n AS BIGINT) AS samples,
       CAST(epoch_us(e) - epoch_us(s) AS DOUBLE) / 1e6 AS duration_seconds
FROM runs WHERE epoch_us(e) - epoch_us(s) >= 300000000"""

def _breaches(samples: str, series: str, bound: float, seconds: int) -> str:
    return f"""
WITH samples AS ({samples}), marked AS (
  SELECT *, sum(CASE WHEN value > {bound} THEN 0 ELSE 1 END) OVER (
    PARTITION BY {series} ORDER BY ts, event_id) AS island
  FROM samples
), runs AS (
  SELECT {series}, island, min(ts) AS s, max(ts) AS e, count(*) AS n
  FROM marked WHERE value > {bound} GROUP BY ALL)
SELECT {series}, strftime(s, '%Y-%m-%d %H:%M:%S') AS breach_start,
       strftime(e, '%Y-%m-%d %H:%M:%S') AS breach_end, CAST(n AS BIGINT) AS samples,
       CAST(epoch_us(e) - epoch_us(s) AS DOUBLE) / 1e6 AS duration_seconds
FROM runs WHERE epoch_us(e) - epoch_us(s) >= {seconds}000000"""


_REQUESTS = """
SELECT event_id, ts, (event_id // 1000 // 2) * 1000
         + CASE WHEN event_id // 1000 % 2 = 1 THEN 1000 ELSE event_id % 1000 END AS done,
       (event_id // 1000 // 2) * 1000
         + CASE WHEN event_id // 1000 % 2 = 1 THEN event_id % 1000 ELSE 0 END AS slow
FROM events"""

_COUNTERS = f"""
WITH requests AS ({_REQUESTS}), counters AS (
  SELECT event_id, ts, CAST('0.5' AS DOUBLE) AS le, CAST(done * 9 + slow * 2 AS DOUBLE) AS value FROM requests
  UNION ALL SELECT event_id, ts, CAST('1' AS DOUBLE), CAST(done * 10 + slow * 3 AS DOUBLE) FROM requests
  UNION ALL SELECT event_id, ts, CAST('5' AS DOUBLE), CAST(done * 10 + slow * 10 AS DOUBLE) FROM requests
  UNION ALL SELECT event_id, ts, CAST('Infinity' AS DOUBLE), CAST(done * 10 + slow * 10 AS DOUBLE)
  FROM requests
)"""

_LATENCY_SAMPLES = f"""
{_COUNTERS}, framed AS (
  SELECT event_id, ts, le, value - first_value(value) OVER recent AS increase,
         CAST(epoch_us(ts) - first_value(epoch_us(ts)) OVER recent AS DOUBLE) / 1e6 AS elapsed
  FROM counters
  WINDOW recent AS (PARTITION BY le ORDER BY ts
                      RANGE BETWEEN INTERVAL 21600 SECOND PRECEDING AND CURRENT ROW)
), rated AS (
  SELECT event_id, ts, le, increase / elapsed AS reached FROM framed WHERE elapsed > 0
), placed AS (
  SELECT *, coalesce(lag(reached) OVER p, 0) AS below, coalesce(lag(le) OVER p, 0) AS lower,
         max(reached) OVER (PARTITION BY event_id) AS total
  FROM rated WINDOW p AS (PARTITION BY event_id ORDER BY le)
), hit AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY le) AS nth
  FROM placed WHERE total > 0 AND reached >= CAST('0.95' AS DOUBLE) * total
)
SELECT '/rankings' AS uri, event_id, ts,
       CASE WHEN isinf(le) THEN lower WHEN reached = below THEN le
            ELSE lower + (le - lower) * ((CAST('0.95' AS DOUBLE) * total - below) / (reached - below)) END AS value
FROM hit WHERE nth = 1"""

_LATENCY = _breaches(_LATENCY_SAMPLES, "uri", 2, 300)


def _grid_rate(samples: str, by: str, step: int, seconds: int) -> str:
    """CTEs from `steps` to `rates`: the rate of each counter at every step of a grid, stretched."""
    return f"""
samples AS ({samples}),
steps AS (
  SELECT unnest(generate_series(min(epoch_us(ts)) // {step}000000 * {step}000000,
                                max(epoch_us(ts)) // {step}000000 * {step}000000, {step}000000)) AS t
  FROM samples),
seen AS (
  SELECT {by}, t, epoch_us(ts) AS us, event_id, CAST(value AS DOUBLE) AS v
  FROM samples JOIN steps ON epoch_us(ts) > t - {seconds}000000 AND epoch_us(ts) <= t),
grown AS (
  SELECT *, CASE WHEN lag(v) OVER w IS NULL THEN 0 WHEN v < lag(v) OVER w THEN v
                 ELSE v - lag(v) OVER w END AS step
  FROM seen WINDOW w AS (PARTITION BY {by}, t ORDER BY us, event_id)),
found AS (
  SELECT {by}, t, CAST(sum(step) AS DOUBLE) AS increase, count(*) AS n,
         arg_min(v, struct_pack(us := us, event_id := event_id)) AS first_v,
         CAST(max(us) - min(us) AS DOUBLE) / 1e6 AS covered,
         CAST(min(us) - t + {seconds}000000 AS DOUBLE) / 1e6 AS ahead,
         CAST(t - max(us) AS DOUBLE) / 1e6 AS behind
  FROM grown GROUP BY {by}, t HAVING count(*) > 1),
reached AS (
  SELECT * REPLACE (
    CASE WHEN ahead >= covered / (n - 1) * CAST('1.1' AS DOUBLE) THEN covered / (n - 1) / 2
         ELSE ahead END AS ahead,
    CASE WHEN behind >= covered / (n - 1) * CAST('1.1' AS DOUBLE) THEN covered / (n - 1) / 2
         ELSE behind END AS behind) FROM found),
rates AS (
  SELECT {by}, t, increase, CASE WHEN covered > 0 THEN increase * ((covered
           + CASE WHEN increase > 0 AND first_v >= 0 AND covered * (first_v / increase) < ahead
                  THEN covered * (first_v / increase) ELSE ahead END + behind) / covered) / {seconds} END AS rate
  FROM reached)"""


_AT = "strftime(make_timestamp({0}), '%Y-%m-%d %H:%M:%S')"


def _range_rate(step: int, seconds: int) -> str:
    return (f"WITH {_grid_rate(_COUNTER, 'series', step, seconds)}"
            f" SELECT series, {_AT.format('t')} AS ts, increase, rate FROM rates")


_RANGE_P95 = f"""
{_COUNTERS}, {_grid_rate("SELECT * FROM counters", "le", 600, 21600)},
placed AS (
  SELECT *, coalesce(lag(rate) OVER p, 0) AS below, coalesce(lag(le) OVER p, 0) AS lower,
         max(rate) OVER (PARTITION BY t) AS total
  FROM rates WHERE rate IS NOT NULL WINDOW p AS (PARTITION BY t ORDER BY le)),
hit AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY le) AS nth
  FROM placed WHERE total > 0 AND rate >= CAST('0.95' AS DOUBLE) * total),
quantiles AS (
  SELECT t, CASE WHEN isinf(le) THEN lower WHEN rate = below THEN le
    ELSE lower + (le - lower) * ((CAST('0.95' AS DOUBLE) * total - below) / (rate - below)) END AS value
  FROM hit WHERE nth = 1),
islands AS (
  SELECT t, t - row_number() OVER (ORDER BY t) * 600000000 AS island FROM quantiles WHERE value > 2)
SELECT '/rankings' AS uri, {_AT.format('min(t)')} AS pending_since,
       {_AT.format('min(t) + 300000000')} AS firing_since, {_AT.format('max(t)')} AS firing_to,
       CAST(count(*) AS BIGINT) AS steps
FROM islands GROUP BY island HAVING max(t) - min(t) >= 300000000"""

_RANGE_GAUGE = f"""
WITH steps AS (
  SELECT unnest(generate_series(min(epoch_us(ts)) // 60000000 * 60000000,
                                max(epoch_us(ts)) // 60000000 * 60000000, 60000000)) AS t FROM events)
SELECT event_type, {_AT.format('t')} AS ts, value FROM (
  SELECT event_type, t, value, row_number() OVER (
    PARTITION BY event_type, t ORDER BY ts DESC, event_id DESC) AS nth
  FROM events JOIN steps ON epoch_us(ts) > t - 300000000 AND epoch_us(ts) <= t)
WHERE nth = 1"""

# What the watermark of a stream of samples has passed at the end.
_PASSED = "epoch_us(ts) <= (SELECT (max(epoch_us(ts)) // 1000 - 5000) * 1000 FROM events)"

_COUNTED = """
SELECT source, count(*) AS records,
       count(*) FILTER (WHERE source <> 'postgres' AND event_id % 5 = 1) AS empty_sale_id,
       count(*) FILTER (WHERE event_id % 5 = 2 OR CAST(value AS DECIMAL(18,2)) = 0) AS zero_amount,
       0 AS time_fallback, 0 AS unstorable_amount
FROM (SELECT *, CASE WHEN event_type IN ('signup', 'click') THEN 'postgres'
                     WHEN event_type IN ('view', 'error') THEN 'files' ELSE 'legacy' END AS source
      FROM events) GROUP BY source"""

_GAUGES = " UNION ALL ".join(
    [f"SELECT 'source_lag/{k}' AS series, CAST(0 AS DOUBLE) AS value" for k in range(3)]
    + [f"SELECT 'observed/quality_' || source || '/{name}', CAST({name} AS DOUBLE) FROM ({_COUNTED})"
       for name in ("records", "empty_sale_id", "zero_amount", "time_fallback", "unstorable_amount")])

_RUNNING = " UNION ALL ".join(
    f"SELECT {portion} AS portion, {_CITY} FROM ({_ranked('city', f'event_id % 3 <= {portion}')})"
    for portion in range(3))

# Source 2 stops at a third of the time, comes up to two thirds, and is let go.
_WATERMARKS = f"""
WITH bounds AS (SELECT min(epoch_us(ts)) AS first, (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 + 1 AS third
                FROM events),
parts AS (SELECT event_id, event_id % 3 AS source, epoch_us(ts) AS us,
                 (epoch_us(ts) - first) // third AS behind FROM events, bounds),
come AS (SELECT unnest(range(3)) AS step),
marks AS (
  SELECT step, CASE step WHEN 2 THEN max(newest) ELSE min(newest) END // 1000 * 1000 - 5000000 AS mark
  FROM (SELECT step, source, max(us) AS newest FROM parts JOIN come ON source < 2 OR behind <= least(step, 1)
        GROUP BY ALL)
  GROUP BY step),
ranked AS ({_ranked('city', 'event_id IN (SELECT event_id FROM parts WHERE source < 2 OR behind <= 1)')})
SELECT CAST(step AS INTEGER) AS step, {_CITY}
FROM ranked JOIN marks ON epoch_us(window_end) <= mark"""

# A window of 720 hours, counted from 1970.
_LONG = f"""
WITH totals AS (
  SELECT make_timestamp(epoch_us(event_time) // 2592000000000 * 2592000000000) AS window_start,
         make_timestamp((epoch_us(event_time) // 2592000000000 + 1) * 2592000000000) AS window_end,
         salesman_name, CAST(sum(amount) AS DECIMAL(28,2)) AS total_sales,
         CAST(count(*) AS BIGINT) AS transaction_count
  FROM ({SALES}) GROUP BY ALL)
SELECT * FROM (
  SELECT *, 'BR' AS country, CAST(row_number() OVER (
    PARTITION BY window_start ORDER BY total_sales DESC, salesman_name) AS INTEGER) AS rank
  FROM totals)
WHERE window_start = TIMESTAMP '2023-12-19 00:00:00' AND rank <= 100"""

_WHOLE = f"""
SELECT * FROM ({CITY_LOG}) AS log
WHERE (window_start, updated_at, batch_id) IN (
  SELECT window_start, updated_at, batch_id FROM (
    SELECT window_start, updated_at, batch_id, row_number() OVER (
      PARTITION BY window_start ORDER BY updated_at DESC, batch_id DESC) AS nth
    FROM ({CITY_LOG})) WHERE nth = 1)"""


_PARSE_TIME = """
SELECT event_id, CAST(CASE event_id % 12
  WHEN 0 THEN epoch_us(ts) // 1000000 * 1000
  WHEN 1 THEN epoch_us(ts) // 1000
  WHEN 2 THEN epoch_us(ts) // 1000
  WHEN 3 THEN epoch_us(ts) // 1000
  WHEN 4 THEN epoch_us(ts) // 1000
  WHEN 5 THEN epoch_us(ts) // 1000
  WHEN 6 THEN epoch_us(ts) // 1000000 * 1000 + 10800000
  WHEN 8 THEN epoch_us(ts) // 1000
  WHEN 9 THEN 1
  ELSE 0 END AS BIGINT) AS event_time_ms
FROM events"""

_DOUBLES = """
SELECT event_id, CASE
  WHEN event_id % 10 < 4 THEN value
  WHEN event_id % 10 = 4 THEN CAST(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'e2' AS DOUBLE)
  WHEN event_id % 10 = 7 THEN 1
  WHEN event_id % 10 = 9 THEN CAST(event_id AS DOUBLE)
  ELSE 0 END AS amount
FROM events"""

_ALIASES = """
SELECT event_id, CASE event_id % 11
  WHEN 0 THEN 'E' || event_id
  WHEN 1 THEN 'E' || event_id
  WHEN 2 THEN CAST(event_id AS VARCHAR)
  WHEN 4 THEN 'E' || event_id
  WHEN 6 THEN event_id || '.5'
  WHEN 7 THEN event_id || '.0'
  WHEN 9 THEN 'true'
  ELSE '' END AS sale_id
FROM events"""

_DQ = """
SELECT event_type AS source, CAST(count(*) AS BIGINT) AS records,
       CAST(count(*) FILTER (WHERE event_id % 7 = 1) AS BIGINT) AS empty_sale_id,
       CAST(count(*) FILTER (WHERE event_id % 7 = 2 OR (value = 0 AND event_id % 7 <> 3)) AS BIGINT) AS zero_amount,
       CAST(count(*) FILTER (WHERE event_id % 7 = 4) AS BIGINT) AS time_fallback,
       CAST(count(*) FILTER (WHERE event_id % 7 = 3) AS BIGINT) AS unstorable_amount
FROM events GROUP BY event_type"""

_MALFORMED = """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN left(props, length(props) - 1)
                                   ELSE replace(props, '"', '') END AS raw
FROM events WHERE event_id % 5 IN (1, 2)"""

_STREAMED_MS = "SELECT make_timestamp(max(epoch_us(ts) // 1000 * 1000)) FROM events"

_REPLACED = f"""
WITH whole AS ({_ranked('city')}), restated AS ({_ranked('city', _country('BR'))})
SELECT {_CITY} FROM (
  SELECT * FROM restated
  UNION ALL BY NAME
  SELECT * FROM whole WHERE window_start NOT IN (SELECT window_start FROM restated))"""


def oracle_sql() -> dict[str, str]:
    return {
        "top_cities_hourly": f"SELECT {_CITY} FROM ({_ranked('city')})",
        "top_salesmen_hourly_br":
            f"SELECT {_SALESMAN} FROM ({_ranked('salesman_name', _country('BR'), 'BR')})",
        "sales_by_city_window":
            f"SELECT {_BOUNDS}, city, total_sales, transaction_count FROM ({_totals('city')})",
        "sales_by_salesman_window":
            f"SELECT {_BOUNDS}, salesman_name, total_sales, transaction_count"
            f" FROM ({_totals('salesman_name', _country('BR'))})",
        "sales_window_15m":
            f"SELECT {_BOUNDS}, city, total_sales, transaction_count FROM ("
            + _totals("city", bucket="time_bucket(INTERVAL 15 MINUTE, event_time)",
                      length="15 MINUTE") + ")",
        "merge_partial_totals":
            f"SELECT {_BOUNDS}, city, total_sales, transaction_count FROM ({_totals('city')})",
        "normalize_postgres": _POSTGRES,
        "normalize_files": _FILES,
        "normalize_legacy": _LEGACY,
        "unify_all_sources": f"{_POSTGRES} UNION ALL {_FILES} UNION ALL {_LEGACY}",
        "top_cities_from_records": f"SELECT {_CITY} FROM ({_ranked('city')})",
        "infer_epoch_ms": """
SELECT event_id,
       CASE event_id % 3 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000
                         ELSE epoch_us(ts) END AS raw_epoch,
       CASE event_id % 3 WHEN 0 THEN epoch_us(ts) // 1000000 * 1000
                         ELSE epoch_us(ts) // 1000 END AS epoch_ms
FROM events""",
        "parse_event_time": _PARSE_TIME,
        "lenient_double": _DOUBLES,
        "alias_string": _ALIASES,
        "dq_counters": _DQ,
        "quarantine_malformed": _MALFORMED,
        "scan_since_mark": f"""
SELECT * FROM ({_RELATIONAL}) WHERE id > (SELECT (max(event_id) + 1) // 3 FROM events)""",
        "scan_backlog": _RELATIONAL,
        "advance_high_water_mark": "SELECT max(event_id) + 1 AS mark FROM events",
        "poll_to_topic": _POSTGRES,
        "poll_by_pages": """
SELECT CAST(event_id + 1 AS VARCHAR) AS key FROM events
WHERE event_id + 1 > (SELECT (max(event_id) + 1) // 2 FROM events)""",
        "record_keys": " UNION ALL ".join(
            f"SELECT '{source}' AS source, {key} AS key FROM events" for source, key in (
                ("postgres", "CAST(event_id + 1 AS VARCHAR)"), ("files", "'E' || event_id"),
                ("legacy", "'E' || event_id"))),
        "legacy_poll": """
WITH timed AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT 'E' || event_id AS sale_id, ms AS event_time_ms, true AS after FROM timed
WHERE ms > (SELECT (min(ms) + max(ms)) // 2 FROM timed)""",
        "csv_stream_by_name": f"""
SELECT sale_id, salesman_name, city, country, amount,
       CASE WHEN product = 'click' THEN '' ELSE product END AS product, sale_date FROM ({_CSV})""",
        "unplaceable_times": """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'placed' ELSE 'aside' END AS kind FROM events""",
        "csv_roundtrip": _CSV,
        "csv_by_name_roundtrip": _CSV,
        "legacy_xml_roundtrip": f"""
SELECT sale_id AS "saleId", salesman_name AS "salesmanName", city, country,
       CAST(amount AS DOUBLE) AS amount, product, epoch_us(event_time) // 1000 AS "saleDate"
FROM ({SALES})""",
        "topic_roundtrip": f"SELECT *, CAST(0 AS BIGINT) AS ingestion_time_ms FROM ({_LEGACY})",
        "rankings_replace": _REPLACED,
        "latest_versions": f"SELECT {_CITY} FROM ({_final(CITY_LOG)})",
        "latest_rankings_city": f"SELECT {_CITY} FROM ({_newest(_final(CITY_LOG))})",
        "latest_rankings_salesman":
            f"SELECT {_SALESMAN} FROM (" + _newest(_final(SALESMAN_LOG), "country = 'BR'") + ")",
        "rankings_for_window_city": f"SELECT {_CITY} FROM ({_window(_final(CITY_LOG))})",
        "rankings_for_window_salesman":
            f"SELECT {_SALESMAN} FROM (" + _window(_final(SALESMAN_LOG), "country = 'AR'") + ")",
        "city_response": _response(_newest(_final(CITY_LOG)), "city", "city"),
        "salesman_response": _response(
            _window(_final(SALESMAN_LOG), "country = 'BR'"), "salesman_name", "salesmanName",
            with_country=True),
        "empty_response": _response(
            _newest(_final(SALESMAN_LOG), "country = 'br'"), "salesman_name", "salesmanName",
            with_country=True),
        "first_ranks": f"SELECT {_SALESMAN} FROM ({_LONG})",
        "latest_whole_windows": f"SELECT {_CITY} FROM ({_WHOLE})",
        "counter_rate_1m": _rate(_COUNTER, "series", 60),
        "counter_rate_5m": _rate(_COUNTER, "series", 300),
        "counter_rate_6h": _rate(_COUNTER, "series", 21600),
        "error_rate": _rate(
            "SELECT event_id, CAST(500 + event_id % 4 AS VARCHAR) AS status, ts,"
            " event_id % 500 AS value FROM events WHERE event_type = 'error'",
            "status", 21600),
        "histogram_quantile": _QUANTILE,
        "latency_buckets": _BUCKETS,
        "sustained_breaches": _BREACHES,
        "latest_gauge": """
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS nth
  FROM events) WHERE nth = 1""",
        "alert_lag": _breaches("SELECT event_type, event_id, ts, value * 500 AS value FROM events",
                               "event_type", 10_000, 300),
        "alert_checkpoint": _breaches(
            "SELECT event_type, event_id, ts, value * 3000 AS value FROM events",
            "event_type", 60_000, 180),
        "alert_latency_p95": _LATENCY,
        "series_by_label":
            f"SELECT event_id, series, value FROM ({_COUNTER}) WHERE series IN ('signup', 'click')",
        "stream_top_cities_hourly": f"SELECT {_CITY} FROM ({_closed(_ranked('city'))})",
        "stream_top_salesmen_hourly_br":
            f"SELECT {_SALESMAN} FROM ("
            + _closed(_ranked("salesman_name", _country("BR"), "BR")) + ")",
        "stream_late_rows": f"SELECT {_CITY} FROM (" + _closed(
            _ranked("city", "event_id % 17 <> 0"),
            "SELECT make_timestamp(max(epoch_us(ts) // 1000 * 1000)) FROM events"
            " WHERE event_id % 17 <> 0") + ")",
        "stream_replay": f"SELECT {_CITY} FROM ({_closed(_ranked('city'), _STREAMED_MS)})",
        "stream_idle_source": f"SELECT {_CITY} FROM ({_closed(_ranked('city'), _STREAMED_MS)})",
        "csv_failing_file": _CSV,
        "stream_gauges": _GAUGES,
        "stream_counter_rate_6h": _rate(f"SELECT * FROM ({_COUNTER}) WHERE {_PASSED}", "series", 21600),
        "stream_alert_lag": _breaches(
            "SELECT event_type, event_id, ts, value * 500 AS value FROM events WHERE " + _PASSED,
            "event_type", 10_000, 300),
        "stream_alert_checkpoint": _breaches(
            "SELECT event_type, event_id, ts, value * 3000 AS value FROM events WHERE " + _PASSED,
            "event_type", 60_000, 180),
        "stream_running_ranking": _RUNNING,
        "stream_source_watermarks": _WATERMARKS,
        "stream_open_windows": f"""
SELECT {_CITY}, window_end > ({_STREAMED_MS}) - INTERVAL 5 SECOND AS open FROM ({_ranked('city')})""",
        "stream_failed_commit":
            f"SELECT {_CITY}, CAST(1 AS BIGINT) AS versions FROM ({_closed(_ranked('city'), _STREAMED_MS)})",
        "range_rate_5m": _range_rate(60, 300),
        "range_rate_6h": _range_rate(1800, 21600),
        "range_latest_gauge": _RANGE_GAUGE,
        "range_alert_p95": _RANGE_P95,
        "stream_quarantine": """
SELECT CASE WHEN event_id % 5 = 0 THEN 'malformed' ELSE 'event' END AS kind,
       'E' || event_id AS sale_id FROM events""",
        "stream_ranking_quarantine": f"""
SELECT DISTINCT 'ranked window' AS reason, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS what
FROM (""" + _closed(_ranked("city", "event_id % 7 > 1"),
                    "SELECT make_timestamp(max(epoch_us(ts) // 1000 * 1000)) FROM events"
                    " WHERE event_id % 7 > 1") + """)
UNION ALL SELECT CASE event_id % 7 WHEN 0 THEN 'unplaceable' ELSE 'unreadable' END, 'E' || event_id
FROM events WHERE event_id % 7 < 2""",
        "stream_end_to_end":
            f"SELECT {_CITY} FROM ({_closed(_ranked('city'), _STREAMED_MS)})",
    }
