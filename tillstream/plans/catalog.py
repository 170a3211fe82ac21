"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import constants as C
from tillstream import schemas
from tillstream.functions import times
from tillstream.operators import alerts, metrics, serve, stepping
from tillstream.operators.aggregate import merge_partials, sales_by_window
from tillstream.operators.normalize import (
    dq_counts, filter_country, normalize_sales, quarantine, read_unified, unify_sources,
    with_event_time,
)
from tillstream.operators.normalize import unplaceable_times as set_aside
from tillstream.operators.rank import top_n_per_window
from tillstream.plans.batch import top_cities, top_salesmen, with_window_text
from tillstream.plans.events import (
    as_sales, csv_rows, legacy_rows, read_events, read_sales, relational_rows, source_records,
    stream_events,
)
from tillstream.session import configure, run_dir
from tillstream.sinks.rankings import (
    append_once, append_rankings, ranking_rows, read_rankings, replace_rankings,
)
from tillstream.sinks.topic import to_topic_records, unified_records, write_topic
from tillstream.sources.csv_sales import read_csv_sales, read_csv_sales_by_name, retired_to
from tillstream.sources.legacy import poll_legacy, read_legacy_sales
from tillstream.sources.relational import (
    advance_mark, poll, relational_records, save_mark, scan_since,
)
from tillstream.sources.topic import read_topic
from tillstream.streaming import open_windows, running, series, watermarks
from tillstream.streaming.progress import progress_samples
from tillstream.streaming.jobs import (
    normalization_job, quarantine_job, ranking_job, ranking_quarantine_job, run_available,
    start_continuous,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

CITY_COLUMNS = ("window_start", "window_end", "city", "total_sales", "transaction_count", "rank")
SALESMAN_COLUMNS = ("window_start", "window_end", "salesman_name", "country", "total_sales",
                    "transaction_count", "rank")
EVENT_COLUMNS = ("sale_id", "salesman_name", "city", "country", "amount", "product",
                 "event_time_ms", "source")


def query(function: Query) -> Query:
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)
    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- windowed totals and rankings --------------------------------------------------

@query
def top_cities_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_window_text(top_cities(read_sales(spark, sf_dir))).select(*CITY_COLUMNS)


@query
def top_salesmen_hourly_br(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_window_text(top_salesmen(read_sales(spark, sf_dir))).select(*SALESMAN_COLUMNS)


@query
def sales_by_city_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_window_text(sales_by_window(read_sales(spark, sf_dir), "city"))


@query
def sales_by_salesman_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = filter_country(read_sales(spark, sf_dir))
    return with_window_text(sales_by_window(sales, "salesman_name"))


@query
def sales_window_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_window_text(sales_by_window(read_sales(spark, sf_dir), "city", "15 minutes"))


@query
def merge_partial_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial totals of each country, as separate flushes would give them, merged per city."""
    sales = read_sales(spark, sf_dir)
    named = F.upper("country").isin("BR", "AR")
    partials = [sales_by_window(part, "city") for part in (
        filter_country(sales, "BR"), filter_country(sales, "AR"),
        sales.where(~F.coalesce(named, F.lit(False))))]
    union = partials[0].unionByName(partials[1]).unionByName(partials[2])
    return with_window_text(merge_partials(union, "city"))


# --- normalization -------------------------------------------------------------------

_NO_TIME = 0


def _normalized(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    records = source_records(read_sales(spark, sf_dir), source)
    return normalize_sales(records, source, now_ms=F.lit(_NO_TIME).cast("bigint"))


@query
def normalize_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "postgres").select(*EVENT_COLUMNS)


@query
def normalize_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "files").select(*EVENT_COLUMNS)


@query
def normalize_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, "legacy").select(*EVENT_COLUMNS)


@query
def unify_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = unify_sources(*[_normalized(spark, sf_dir, source) for source in C.SOURCES])
    return events.select(*EVENT_COLUMNS)


def _parts(sales: DataFrame) -> dict[str, DataFrame]:
    """Every sale in one of the three sources, by product; all others come from the last."""
    product = F.coalesce("product", F.lit(""))
    first, second = product.isin("signup", "click"), product.isin("view", "error")
    return {"postgres": sales.where(first), "files": sales.where(second),
            "legacy": sales.where(~first & ~second)}


@query
def top_cities_from_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the raw records of three sources, each sale in one of them, to the city ranking."""
    sales = read_sales(spark, sf_dir)
    events = unify_sources(*[
        normalize_sales(source_records(part, source), source)
        for source, part in _parts(sales).items()])
    return with_window_text(top_cities(with_event_time(events))).select(*CITY_COLUMNS)


@query
def infer_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as seconds, milliseconds or microseconds, told apart by size alone."""
    unit = F.pmod("event_id", F.lit(3))
    raw = (
        F.when(unit == 0, F.unix_seconds("ts"))
        .when(unit == 1, F.unix_millis("ts"))
        .otherwise(F.unix_micros("ts"))
    )
    return read_events(spark, sf_dir).select(
        "event_id", raw.alias("raw_epoch"), times.infer_epoch_ms(raw).alias("epoch_ms"))


def _json_variants(events: DataFrame, shapes: list[Column]) -> DataFrame:
    """One JSON text per event, cycling through the shapes by id."""
    number = F.pmod("event_id", F.lit(len(shapes)))
    text = F.when(number == 0, shapes[0])
    for i, shape in enumerate(shapes[1:], start=1):
        text = text.when(number == i, shape)
    return events.select("event_id", text.alias("value"))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _read_back(records: DataFrame, column: str) -> DataFrame:
    """One column of the normalized records, by event."""
    now = F.lit(_NO_TIME).cast("bigint")
    return normalize_sales(records, "any", now_ms=now, carry=["event_id"]).select("event_id", column)


@query
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time in ms from every accepted and several rejected JSON forms."""
    ms = F.unix_millis("ts")
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    shapes = [
        _text('{"eventTime":', F.unix_seconds("ts"), "}"),
        _text('{"eventTime":', ms, "}"),
        _text('{"saleDate":', F.unix_micros("ts"), "}"),
        _text('{"eventTime":"', ms, '"}'),
        _text('{"sale_date":"', times.iso_instant(F.col("ts")), '"}'),
        _text('{"sale_date":"', times.iso_local(F.col("ts")), '"}'),
        _text('{"event_time":null,"created_at":"', second, '-03:00"}'),
        _text('{"eventTime":"', F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
              '","created_at":', ms, "}"),
        _text('{"eventTime":', ms, ".5}"),
        _text('{"eventTime":true,"x":', F.col("event_id"), "}"),
        _text('{"eventTime":{"ms":', ms, "}}"),
        _text('{"eventTime":" ', ms, '"}'),
    ]
    return _read_back(_json_variants(read_events(spark, sf_dir), shapes), "event_time_ms")


@query
def lenient_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts from numbers, number texts, and things that are no number."""
    money = F.col("value").cast(schemas.MONEY).cast("string")
    events = read_events(spark, sf_dir)
    shapes = [
        _text('{"amount":', money, "}"),
        _text('{"amount":"', money, '"}'),
        _text('{"amount":" ', money, ' "}'),
        _text('{"amount":"', money, 'd"}'),
        _text('{"amount":"', money, 'e2"}'),
        _text('{"amount":"R$', money, '"}'),
        _text('{"amount":null,"total":', money, "}"),
        _text('{"amount":true,"total":', money, "}"),
        _text('{"amount":[', money, "]}"),
        _text('{"amount":', F.col("event_id"), "}"),
    ]
    number = F.pmod("event_id", F.lit(len(shapes)))
    text = F.element_at(F.array(*shapes), number.cast("int") + 1)
    return _read_back(events.select("event_id", text.alias("value")), "amount")


@query
def alias_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale ids under each alias, as text, number, flag, container, empty and missing."""
    number = F.col("event_id")
    shapes = [
        _text('{"saleId":"E', number, '"}'),
        _text('{"sale_id":"E', number, '"}'),
        _text('{"id":', number, "}"),
        _text('{"saleId":"","id":', number, "}"),
        _text('{"saleId":null,"sale_id":"E', number, '"}'),
        _text('{"saleId":{"n":', number, '},"id":"E"}'),
        _text('{"id":', number, ".5}"),
        _text('{"id":', number, ".0}"),
        _text('{"sale":', number, "}"),
        _text('{"id":true,"n":', number, "}"),
        _text("[", number, "]"),
    ]
    return _read_back(_json_variants(read_events(spark, sf_dir), shapes), "sale_id")


@query
def dq_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality counters by source, over records damaged in turn."""
    sales = read_sales(spark, sf_dir)
    damage = F.pmod("event_id", F.lit(7))
    damaged = sales.select(
        F.when(damage == 1, "").otherwise(F.col("sale_id")).alias("sale_id"),
        F.when(damage == 2, "n/a").when(damage == 3, "NaN")
        .otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(damage == 4, "yesterday")
        .otherwise(times.iso_instant(F.col("event_time"))).alias("sale_date"),
        F.col("product").alias("source"),
    )
    records = to_topic_records(damaged)
    now = F.lit(_NO_TIME).cast("bigint")
    return dq_counts(normalize_sales(records, now_ms=now, with_flags=True))


@query
def unplaceable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as numbers of three sizes; those beyond TIMESTAMP have no window and are set
    aside. Placed and set aside, all events are there."""
    part = F.pmod("event_id", F.lit(3))
    ms = F.unix_millis("ts")
    number = F.when(part == 0, ms).when(part == 1, F.lit(2**63 - 1)).otherwise(-ms - 10**16)
    events = _read_back(read_events(spark, sf_dir).select(
        "event_id", _text('{"eventTime":"', number, '"}').alias("value")), "event_time_ms")
    placed = with_event_time(events.withColumn("amount", F.lit(0.0)))
    return placed.select("event_id", F.lit("placed").alias("kind")).unionByName(
        set_aside(events).select("event_id", F.lit("aside").alias("kind")))


@query
def quarantine_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records cut short or left unquoted are set aside; whole ones are not."""
    props = F.col("props")
    shapes = [
        props,
        F.expr("left(props, length(props) - 1)"),
        F.regexp_replace(props, '"', ""),
        F.lit(""),
        _text("[", props, "]"),
    ]
    number = F.pmod("event_id", F.lit(len(shapes)))
    text = F.element_at(F.array(*shapes), number.cast("int") + 1)
    raw = read_events(spark, sf_dir).select("event_id", text.alias("raw"))
    return quarantine(raw, "raw")


# --- sources and sinks ---------------------------------------------------------------

RELATIONAL_OUT = ("id", "salesman_id", "salesman", "city", "country", "amount", "product",
                  "sale_date", "created_at")


@query
def scan_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational table above a mark at a third of its keys."""
    table = relational_rows(read_sales(spark, sf_dir))
    mark = table.agg(F.max("id")).first()[0] // 3
    return relational_records(scan_since(table, mark)).select(*RELATIONAL_OUT)


@query
def scan_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything above the mark in one unpaged scan."""
    table = relational_rows(read_sales(spark, sf_dir))
    return relational_records(scan_since(table, 0)).select(*RELATIONAL_OUT)


@query
def advance_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advance_mark(relational_rows(read_sales(spark, sf_dir)), 0)


@query
def poll_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll the relational table into a topic until nothing is new, then read the topic."""
    base = run_dir(spark, "poll")
    topic, marks = f"{base}/topic", f"{base}/marks"
    table = relational_rows(read_sales(spark, sf_dir))

    def send(rows: DataFrame) -> None:
        write_topic(to_topic_records(relational_records(rows)), topic, fmt="parquet")

    poll(spark, table, marks, send)
    poll(spark, table, marks, send)
    records = read_topic(spark, topic, fmt="parquet", streaming=False)
    return normalize_sales(
        records, "postgres", now_ms=F.lit(_NO_TIME).cast("bigint")).select(*EVENT_COLUMNS)


@query
def poll_by_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a mark at half of the keys, page by page until nothing is left; the record keys."""
    base = run_dir(spark, "pages")
    topic, marks = f"{base}/topic", f"{base}/marks"
    table = relational_rows(read_sales(spark, sf_dir))
    highest = table.agg(F.max("id")).first()[0]
    save_mark(spark, marks, highest // 2)

    def send(rows: DataFrame) -> None:
        write_topic(to_topic_records(relational_records(rows)), topic, fmt="parquet")

    poll(spark, table, marks, send, page=highest // 8 + 1)
    return spark.read.schema("key STRING, value STRING").parquet(topic).select("key")


@query
def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the source topics' records, and how long their values are."""
    sales = read_sales(spark, sf_dir)
    parts = [source_records(sales, source).select(F.lit(source).alias("source"), "key")
             for source in C.SOURCES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def legacy_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy responses polled from a time within them; a failed poll keeps the time."""
    base = run_dir(spark, "legacy")
    sales = legacy_rows(read_sales(spark, sf_dir))
    (sales.write.format("xml").option("rootTag", "response").option("rowTag", "sales")
     .save(f"{base}/in"))
    oldest, newest = sales.agg(F.min("saleDate"), F.max("saleDate")).first()
    since = (oldest + newest) // 2
    marks = f"{base}/marks"
    save_mark(spark, marks, since, C.LEGACY_PRODUCER)

    def fail(rows: DataFrame) -> None:
        raise ConnectionError

    def send(rows: DataFrame) -> None:
        write_topic(to_topic_records(rows), f"{base}/topic", fmt="parquet")

    with suppress(ConnectionError):
        poll_legacy(spark, f"{base}/in", marks, fail, newest)
    poll_legacy(spark, f"{base}/in", marks, send, newest)
    poll_legacy(spark, f"{base}/in", marks, send, newest)
    sent = read_topic(spark, f"{base}/topic", fmt="parquet", streaming=False)
    events = normalize_sales(sent, "legacy", now_ms=F.lit(_NO_TIME).cast("bigint"))
    lowest = F.lit(since).cast("bigint").alias("since_ms")
    return events.select("sale_id", "event_time_ms").withColumn("after", F.col("event_time_ms") > lowest)


@query
def csv_stream_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts, some empty cells, streamed by the names in their headers."""
    base = run_dir(spark, "csv-stream")
    rows = csv_rows(read_sales(spark, sf_dir)).withColumn(
        "product", F.when(F.col("product") == "click", "").otherwise(F.col("product")))
    brazil = F.upper("country") == C.RANKED_COUNTRY
    writer = {"header": True, "emptyValue": ""}
    rows.where(brazil).write.options(**writer).csv(f"{base}/in/usual")
    (rows.where(~brazil).select(*reversed(C.CSV_COLUMNS))
     .write.options(**writer).csv(f"{base}/in/reversed"))
    stream = read_csv_sales_by_name(spark, f"{base}/in", streaming=True)
    run_available(stream.writeStream.format("parquet").option("path", f"{base}/out")
                  .option("checkpointLocation", f"{base}/checkpoint"))
    return spark.read.schema(schemas.CSV_SALE).parquet(f"{base}/out")


@query
def csv_failing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two portions of files, retired once they are read. The second portion's micro-batch fails in the
    middle of a file and is run again: no row is lost, none is there twice."""
    base = run_dir(spark, "csv-failing")
    rows = csv_rows(read_sales(spark, sf_dir))
    half = _number_of("sale_id") % 2

    def run(cells: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        stream = read_csv_sales(spark, f"{base}/in", streaming=True, options=retired_to(f"{base}/done"))
        run_available(cells(stream).writeStream.format("parquet").option("path", f"{base}/out")
                      .option("checkpointLocation", f"{base}/checkpoint"))

    def fail_midway(rows: DataFrame) -> DataFrame:
        broken = _number_of("sale_id") % 100 == 51
        return rows.withColumn("city", F.when(broken, F.raise_error(F.lit("lost"))).otherwise(F.col("city")))

    rows.where(half == 0).write.option("header", True).csv(f"{base}/in/first")
    run()
    rows.where(half == 1).write.option("header", True).csv(f"{base}/in/second")
    with suppress(StreamingQueryException):
        run(fail_midway)
    run()
    return spark.read.schema(schemas.CSV_SALE).parquet(f"{base}/out")


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "csv")
    csv_rows(read_sales(spark, sf_dir)).write.option("header", True).csv(path)
    return read_csv_sales(spark, path)


@query
def csv_by_name_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts, read together by the names in their headers."""
    path = run_dir(spark, "csv-names")
    rows = csv_rows(read_sales(spark, sf_dir))
    brazil = F.upper("country") == C.RANKED_COUNTRY
    rows.where(brazil).write.option("header", True).csv(f"{path}/usual")
    (rows.where(~brazil).select(*reversed(C.CSV_COLUMNS))
     .write.option("header", True).csv(f"{path}/reversed"))
    return read_csv_sales_by_name(spark, path)


@query
def legacy_xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "xml")
    (legacy_rows(read_sales(spark, sf_dir)).write.format("xml")
     .option("rootTag", "response").option("rowTag", "sales").save(path))
    return read_legacy_sales(spark, path, since_ms=0)


@query
def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source topic to events to unified topic to events."""
    base = run_dir(spark, "topic")
    source, unified = f"{base}/source", f"{base}/unified"
    write_topic(source_records(read_sales(spark, sf_dir), "legacy"), source, fmt="parquet")
    events = normalize_sales(
        read_topic(spark, source, fmt="parquet", streaming=False), "legacy",
        now_ms=F.lit(_NO_TIME).cast("bigint"))
    write_topic(unified_records(events), unified, fmt="text")
    return read_unified(read_topic(spark, unified, fmt="text", streaming=False))


@query
def rankings_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank all sales, then restate the windows with BR sales from those alone."""
    path = run_dir(spark, "rankings")
    sales = read_sales(spark, sf_dir)
    replace_rankings(ranking_rows(top_cities(sales), batch_id=0), path)
    replace_rankings(ranking_rows(top_cities(filter_country(sales)), batch_id=1), path)
    table = read_rankings(spark, path, schemas.CITY_RANKING)
    return with_window_text(serve.latest_windows(table)).select(*CITY_COLUMNS)


# --- serving reads -------------------------------------------------------------------

SERVED_WINDOW = "2024-01-15T12:00:00Z"


def _version(ranked: DataFrame, seconds: int, batch_id: int) -> DataFrame:
    updated_at = F.col("window_end") + F.make_interval(secs=F.lit(seconds))
    return ranking_rows(ranked, updated_at, batch_id)


def city_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of the city ranking: all sales, BR only, and in the same second US only."""
    sales = read_sales(spark, sf_dir)
    versions = [
        _version(top_cities(sales), 5, 1),
        _version(top_cities(filter_country(sales, "BR")), 35, 2),
        _version(top_cities(filter_country(sales, "US")), 35, 3),
    ]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


def salesman_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The BR ranking, partly replaced by a later AR ranking of the same windows."""
    sales = read_sales(spark, sf_dir)
    return _version(top_salesmen(sales, "BR"), 5, 1).unionByName(
        _version(top_salesmen(sales, "AR"), 35, 2))


def _written(spark: SparkSession, log: DataFrame, name: str, key_schema) -> DataFrame:
    path = run_dir(spark, name)
    append_rankings(log, path)
    return read_rankings(spark, path, key_schema)


@query
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, city_log(spark, sf_dir), "city-log", schemas.CITY_RANKING)
    return with_window_text(serve.latest_by_key(table)).select(*CITY_COLUMNS)


@query
def latest_rankings_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, city_log(spark, sf_dir), "city-log", schemas.CITY_RANKING)
    return with_window_text(serve.latest_rankings(table)).select(*CITY_COLUMNS)


@query
def latest_rankings_salesman(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, salesman_log(spark, sf_dir), "man-log", schemas.SALESMAN_RANKING)
    return with_window_text(serve.latest_rankings(table, "BR")).select(*SALESMAN_COLUMNS)


@query
def rankings_for_window_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, city_log(spark, sf_dir), "city-log", schemas.CITY_RANKING)
    return with_window_text(
        serve.rankings_for_window(table, SERVED_WINDOW)).select(*CITY_COLUMNS)


@query
def rankings_for_window_salesman(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, salesman_log(spark, sf_dir), "man-log", schemas.SALESMAN_RANKING)
    return with_window_text(
        serve.rankings_for_window(table, SERVED_WINDOW, "AR")).select(*SALESMAN_COLUMNS)


def _as_json(response: DataFrame) -> DataFrame:
    return response.select(F.to_json(F.struct("window", "rankings")).alias("response"))


@query
def city_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, city_log(spark, sf_dir), "city-log", schemas.CITY_RANKING)
    return _as_json(serve.top_sales_by_city(table))


@query
def salesman_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _written(spark, salesman_log(spark, sf_dir), "man-log", schemas.SALESMAN_RANKING)
    return _as_json(serve.top_salesmen(table, SERVED_WINDOW))


@query
def empty_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country nobody ranked, in other letter case than the stored one."""
    table = _written(spark, salesman_log(spark, sf_dir), "man-log", schemas.SALESMAN_RANKING)
    return _as_json(serve.top_salesmen(table, country="br"))


@query
def latest_whole_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each window as a whole: no rank of an older one is left."""
    table = _written(spark, city_log(spark, sf_dir), "city-log", schemas.CITY_RANKING)
    return with_window_text(serve.latest_windows(table)).select(*CITY_COLUMNS)


LONG_WINDOW = "720 hours"
LONG_WINDOW_START = "2023-12-19T00:00:00Z"


@query
def first_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read of a window with over 100 ranks, with a limit beyond the upper bound of 100."""
    totals = sales_by_window(read_sales(spark, sf_dir), "salesman_name", LONG_WINDOW)
    ranked = top_n_per_window(totals, "salesman_name", 2000, salts=16)
    rows = ranked.withColumn("country", F.lit("BR"))
    log = _written(spark, ranking_rows(rows), "long-log", schemas.SALESMAN_RANKING)
    return with_window_text(
        serve.rankings_for_window(log, LONG_WINDOW_START, limit=1000)).select(*SALESMAN_COLUMNS)


# --- metrics -------------------------------------------------------------------------

def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type a rising counter that starts again every 500 events."""
    return read_events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("series"), "ts",
        F.pmod("event_id", F.lit(500)).alias("value"))


def _rate(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    rated = metrics.counter_rate(
        counter_samples(spark, sf_dir), "series", seconds, seq="event_id")
    return rated.select(
        "event_id", "series", "increase", "rate")


@query
def counter_rate_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 60)


@query
def counter_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 300)


@query
def counter_rate_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 21_600)


@query
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of the request counters whose status label is 5xx."""
    samples = counter_samples(spark, sf_dir).withColumn(
        "status",
        F.when(F.col("series") == "error", (F.lit(500) + F.pmod("event_id", F.lit(4)))
               .cast("string")).otherwise("200"))
    rated = metrics.error_rate(samples, "status", 21_600, seq="event_id")
    return rated.select(
        "event_id", "status", "increase", "rate")


LATENCY_BOUNDS = (10, 25, 50, 100, 250, 500)


@query
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95th percentile of value per event type, from cumulative buckets."""
    buckets = metrics.cumulative_buckets(
        read_events(spark, sf_dir), "event_type", "value", LATENCY_BOUNDS)
    return metrics.histogram_quantile(buckets, "event_type").select(
        "event_type", "quantile_value")


@query
def latency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cumulative_buckets(
        read_events(spark, sf_dir), "event_type", "value", LATENCY_BOUNDS)


@query
def sustained_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of at least 5 minutes in which every value of an event type is above 20."""
    found = metrics.sustained_breaches(
        read_events(spark, sf_dir), "event_type", 20, 300, seq="event_id")
    return found.select(
        "event_type",
        times.format_window(F.col("breach_start")).alias("breach_start"),
        times.format_window(F.col("breach_end")).alias("breach_end"),
        "samples", "duration_seconds")


def _breaches(found: DataFrame, series: str) -> DataFrame:
    return found.select(
        series, times.format_window(F.col("breach_start")).alias("breach_start"),
        times.format_window(F.col("breach_end")).alias("breach_end"), "samples", "duration_seconds")


@query
def alert_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as consumer lag, 500 records for each unit."""
    samples = read_events(spark, sf_dir).withColumn("lag", F.col("value") * 500)
    return _breaches(alerts.consumer_lag(
        samples, "event_type", value="lag", seq="event_id"), "event_type")


@query
def alert_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as checkpoint times, 3000 ms for each unit."""
    samples = read_events(spark, sf_dir).withColumn("took_ms", F.col("value") * 3000)
    return _breaches(alerts.checkpoint_time(
        samples, "event_type", value="took_ms", seq="event_id"), "event_type")


def _request_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request buckets of one endpoint, read at every event, fast and slow by turns of 1000 requests."""
    turn = F.floor(F.col("event_id") / 1000)
    done = F.floor(turn / 2) * 1000 + F.when(turn % 2 == 1, 1000).otherwise(
        F.pmod("event_id", F.lit(1000)))
    slow = F.floor(turn / 2) * 1000 + F.when(turn % 2 == 1, F.pmod("event_id", F.lit(1000))).otherwise(0)
    # Of 10 fast requests 9 take up to half a second, of 10 slow ones 2; all others up to 5.
    buckets = F.array(
        F.struct(F.lit(0.5).alias("le"), (done * 9 + slow * 2).cast("double").alias("value")),
        F.struct(F.lit(1.0).alias("le"), (done * 10 + slow * 3).cast("double").alias("value")),
        F.struct(F.lit(5.0).alias("le"), (done * 10 + slow * 10).cast("double").alias("value")),
        F.struct(F.lit(float("inf")).alias("le"), (done * 10 + slow * 10).cast("double").alias("value")))
    return read_events(spark, sf_dir).select(
        "event_id", "ts", F.lit("/rankings").alias("uri"), F.inline(buckets))


@query
def alert_latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over six hours, as events are minutes apart."""
    samples = _request_buckets(spark, sf_dir)
    return _breaches(alerts.latency_p95(samples, "uri", "event_id", rate_seconds=21_600), "uri")


@query
def latest_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = metrics.latest_gauge(read_events(spark, sf_dir), "event_type", seq="event_id")
    return newest.select("event_type", times.format_window(F.col("ts")).alias("ts"), "value")


@query
def series_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose label matches a pattern as a whole."""
    return metrics.matching_series(
        counter_samples(spark, sf_dir), "series", "si.*|.*ck|erro").select(
        "event_id", "series", "value")


# --- streaming -----------------------------------------------------------------------

@query
def stream_top_cities_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream-cities")
    sales = as_sales(stream_events(spark, sf_dir))
    run_available(ranking_job(sales, "city", f"{base}/table", f"{base}/checkpoint"))
    table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
    return with_window_text(serve.latest_by_key(table)).select(*CITY_COLUMNS)


@query
def stream_top_salesmen_hourly_br(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream-salesmen")
    sales = as_sales(stream_events(spark, sf_dir))
    run_available(ranking_job(
        sales, "salesman_name", f"{base}/table", f"{base}/checkpoint",
        country=C.RANKED_COUNTRY))
    table = read_rankings(spark, f"{base}/table", schemas.SALESMAN_RANKING)
    return with_window_text(serve.latest_by_key(table)).select(*SALESMAN_COLUMNS)


@query
def stream_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three source topics, normalization stream, unified topic, ranking stream, table."""
    base = run_dir(spark, "stream-chain")
    sales = read_sales(spark, sf_dir)
    for source, part in _parts(sales).items():
        write_topic(source_records(part, source), f"{base}/{source}", fmt="parquet")
    topics = {
        source: read_topic(spark, f"{base}/{source}", fmt="parquet") for source in C.SOURCES}
    run_available(normalization_job(
        topics, f"{base}/unified", f"{base}/normalization", fmt="text"))
    unified = with_event_time(read_unified(read_topic(spark, f"{base}/unified", fmt="text")))
    run_available(ranking_job(unified, "city", f"{base}/table", f"{base}/ranking"))
    table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
    return with_window_text(serve.latest_by_key(table)).select(*CITY_COLUMNS)


# --- streams of several micro-batches -----------------------------------------------------

class _Topic:
    """A unified topic that gets its events in portions, each a run of the ranking job."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.portions = spark, run_dir(spark, name), 0

    def add(self, sales: DataFrame) -> None:
        events = normalize_sales(source_records(sales, "legacy"), "legacy")
        write_topic(unified_records(events), f"{self.base}/topic/portion={self.portions}", fmt="text")
        self.portions += 1

    def run(self, checkpoint: str = "checkpoint") -> None:
        records = read_topic(self.spark, f"{self.base}/topic/*", fmt="text")
        run_available(ranking_job(with_event_time(read_unified(records)), "city",
                                  f"{self.base}/table", f"{self.base}/{checkpoint}"))

    def rankings(self) -> DataFrame:
        table = read_rankings(self.spark, f"{self.base}/table", schemas.CITY_RANKING)
        return with_window_text(serve.latest_windows(table)).select(*CITY_COLUMNS)


def _number_of(sale_id: str) -> Column:
    return F.substring(sale_id, 2, 20).cast("bigint")


def _is_late() -> Column:
    return F.pmod("event_id", F.lit(17)) == 0


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 17th sale comes after the watermark has passed all: its window closes without it."""
    sales = read_sales(spark, sf_dir)
    newest = sales.where(~_is_late()).agg(F.max("event_time")).first()[0]
    topic = _Topic(spark, "stream-late")
    for portion in (sales.where(~_is_late() & (F.col("event_time") < newest)),
                    sales.where(~_is_late() & (F.col("event_time") == newest)),
                    sales.where(_is_late())):
        topic.add(portion)
        topic.run()
    return topic.rankings()


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job loses its checkpoint and ranks everything again into the same table."""
    sales = read_sales(spark, sf_dir)
    topic = _Topic(spark, "stream-replay")
    topic.add(sales)
    topic.run()
    topic.run("another-checkpoint")
    return topic.rankings()


@query
def stream_idle_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales come on two of three source topics, the third never gets one; windows close all the same."""
    base = run_dir(spark, "stream-idle")
    sales = read_sales(spark, sf_dir)
    even = F.pmod("event_id", F.lit(2)) == 0
    live = {"postgres": sales.where(even), "files": sales.where(~even), "legacy": sales.where(F.lit(False))}
    for source, part in live.items():
        write_topic(source_records(part, source), f"{base}/{source}", fmt="parquet")
    events = unify_sources(*[
        normalize_sales(read_topic(spark, f"{base}/{source}", fmt="parquet"), source)
        for source in C.SOURCES])
    run_available(ranking_job(with_event_time(events), "city", f"{base}/table",
                              f"{base}/checkpoint"))
    table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
    return with_window_text(serve.latest_windows(table)).select(*CITY_COLUMNS)


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth record cut short: events and quarantined records are all that came in."""
    base = run_dir(spark, "stream-quarantine")
    records = source_records(read_sales(spark, sf_dir), "legacy")
    cut = _number_of("key") % 5 == 0
    damaged = records.select("key", F.when(cut, F.expr("left(value, length(value) - 1)"))
                             .otherwise(F.col("value")).alias("value"))
    write_topic(damaged, f"{base}/legacy", fmt="parquet")
    topics = {"legacy": read_topic(spark, f"{base}/legacy", fmt="parquet")}
    run_available(normalization_job(topics, f"{base}/unified", f"{base}/normalization", fmt="text"))
    run_available(quarantine_job(topics, f"{base}/aside", f"{base}/quarantine"))
    events = read_unified(read_topic(spark, f"{base}/unified", fmt="text", streaming=False))
    aside = spark.read.schema("source STRING, value STRING").parquet(f"{base}/aside")
    return events.select(F.lit("event").alias("kind"), "sale_id").unionByName(aside.select(
        F.lit("malformed").alias("kind"),
        F.regexp_extract("value", '"saleId":"([^"]*)"', 1).alias("sale_id")))


@query
def stream_ranking_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified records that no ranking can use, by reason; the rankings go on without them."""
    base = run_dir(spark, "ranking-quarantine")
    events = normalize_sales(source_records(read_sales(spark, sf_dir), "legacy"), "legacy")
    number = _number_of("sale_id") % 7
    timed = events.withColumn("event_time_ms", F.when(number == 0, F.lit(2**62)).otherwise(
        F.col("event_time_ms")))
    records = unified_records(timed.where(number != 1)).unionByName(
        timed.where(number == 1).select(F.concat(F.lit("{"), "sale_id").alias("value")))
    write_topic(records, f"{base}/unified", fmt="text")
    stream = read_topic(spark, f"{base}/unified", fmt="text")
    run_available(ranking_job(with_event_time(read_unified(stream)), "city", f"{base}/table",
                              f"{base}/ranking"))
    run_available(ranking_quarantine_job(stream, f"{base}/aside", f"{base}/quarantine"))
    table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
    ranked = serve.latest_windows(table).select(F.lit("ranked window").alias("reason"),
                                                F.col("window_start").cast("string").alias("what"))
    aside = spark.read.schema("reason STRING, value STRING").parquet(f"{base}/aside")
    what = F.coalesce(F.get_json_object("value", "$.saleId"), F.expr("substring(value, 2)"))
    return ranked.distinct().unionByName(aside.select("reason", what.alias("what")))


class _Portions:
    """Rows that come in portions of time, each followed by a run of a job that starts anew."""

    def __init__(self, spark: SparkSession, name: str, rows: DataFrame, ts: str, portions: int = 3):
        self.spark, self.base = spark, run_dir(spark, name)
        self.rows, self.ts, self.portions = rows, ts, portions
        at = F.unix_micros(F.col(ts))
        first, last = rows.agg(F.min(at), F.max(at)).first()
        if first is not None:
            span = (last - first) // portions + 1
            self.part = F.call_function("div", at - F.lit(first), F.lit(span))

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.rows.schema).parquet(f"{self.base}/rows/*")

    def run_each(self, start: Callable[[DataFrame], None]) -> None:
        for number in range(self.portions):
            self.rows.where(self.part == number).write.parquet(f"{self.base}/rows/portion={number}")
            start(self.stream())

    def to_files(self, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What a streaming job has appended after all portions."""
        def start(stream: DataFrame) -> None:
            run_available(job(stream).writeStream.format("parquet").outputMode("append")
                          .option("checkpointLocation", f"{self.base}/checkpoint")
                          .option("path", f"{self.base}/out"))
        self.run_each(start)
        return self.spark.read.schema(job(self.rows).schema).parquet(f"{self.base}/out")


@query
def stream_counter_rate_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`counter_rate_6h` over a stream of three portions with restarts between: all closed samples."""
    portions = _Portions(spark, "stream-rate", counter_samples(spark, sf_dir), "ts")
    rated = portions.to_files(lambda samples: series.stream_counter_rate(
        samples, "series", 21_600, seq="event_id"))
    return rated.select(F.col("seq").alias("event_id"), "series", "increase", "rate")


def _streamed_breaches(spark: SparkSession, name: str, samples: DataFrame, rule: tuple[float, int],
                       value: str) -> DataFrame:
    log = _Portions(spark, name, samples, "ts").to_files(lambda rows: series.stream_alert(
        rows, "event_type", rule, value=value, seq="event_id"))
    return _breaches(series.alert_stretches(log, "event_type"), "event_type")


@query
def stream_alert_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`alert_lag` over a stream of three portions with restarts between."""
    samples = read_events(spark, sf_dir).withColumn("lag", F.col("value") * 500)
    return _streamed_breaches(spark, "stream-lag", samples, C.LAG_RULE, "lag")


@query
def stream_alert_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`alert_checkpoint` over a stream of three portions with restarts between."""
    samples = read_events(spark, sf_dir).withColumn("took_ms", F.col("value") * 3000)
    return _streamed_breaches(spark, "stream-checkpoint", samples, C.CHECKPOINT_MS_RULE, "took_ms")


@query
def stream_running_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first cities of every window after each of three portions that all windows get a part of."""
    base = run_dir(spark, "running-ranking")
    sales = read_sales(spark, sf_dir)
    seen = []
    for number in range(3):
        (sales.where(F.pmod("event_id", F.lit(3)) == number).select("event_time", "amount", "city")
         .write.parquet(f"{base}/sales/portion={number}"))
        stream = spark.readStream.schema("event_time TIMESTAMP, amount DECIMAL(18,2), city STRING").parquet(
            f"{base}/sales/*")
        # No window closes while a later portion may add to it.
        run_available(running.running_ranking_job(
            stream, "city", f"{base}/ranking", f"{base}/checkpoint", out_of_order="400 days"))
        upto = running.ranking_changes(spark, f"{base}/ranking", "city")
        last = upto.agg(F.max(running.BATCH)).first()[0]
        seen.append(running.folded(upto.where(F.col(running.BATCH) <= F.lit(last))).withColumn(
            "portion", F.lit(number)))
    found = seen[0].unionByName(seen[1]).unionByName(seen[2])
    return with_window_text(found).select("portion", *CITY_COLUMNS)


@query
def stream_source_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources with a watermark each. First one of them stops at a third of the time; then it comes
    up to two thirds; then, after a restart, it is found idle and let go. After each step, what has closed."""
    base = run_dir(spark, "source-watermarks")
    sales = read_sales(spark, sf_dir).select("event_id", "event_time", "amount", "city")
    at = F.unix_micros("event_time")
    first, last = sales.agg(F.min(at), F.max(at)).first()
    first, last = first or 0, last or 0
    of = F.pmod("event_id", F.lit(3))
    third = F.call_function("div", at - F.lit(first), F.lit((last - first) // 3 + 1))
    idle = watermarks.IdleSources(spark, f"{base}/beats", list(C.SOURCES))
    closed = []

    def arrive(part: DataFrame) -> None:
        for k, source in enumerate(C.SOURCES):
            part.where(of == k).drop("event_id").write.parquet(f"{base}/{source}/step={len(closed)}")

    def start() -> StreamingQuery:
        streams = {source: spark.readStream.schema(
            "event_time TIMESTAMP, amount DECIMAL(18,2), city STRING").parquet(f"{base}/{source}/*")
            for source in C.SOURCES}
        events = watermarks.with_source_watermarks(streams, heartbeats=f"{base}/beats")
        return start_continuous(ranking_job(events, "city", f"{base}/table", f"{base}/checkpoint",
                                            one_watermark=False), "0 seconds")

    def settle(query: StreamingQuery) -> None:
        query.processAllAvailable()
        table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
        table.write.parquet(f"{base}/after={len(closed)}")
        closed.append(serve.latest_windows(read_rankings(
            spark, f"{base}/after={len(closed)}", schemas.CITY_RANKING)).withColumn(
            "step", F.lit(len(closed))))

    watermarks.prepare_heartbeats(spark, f"{base}/beats", list(C.SOURCES))
    append_rankings(spark.createDataFrame([], schemas.CITY_RANKING), f"{base}/table")
    arrive(sales.where((of != 2) | (third == 0)))
    query = start()
    try:
        settle(query)
        arrive(sales.where((of == 2) & (third == 1)))
        settle(query)
        idle.look(query)
        query.stop()
        idle.carry_over()
        query = start()
        idle.idle_seconds = 0
        idle.look(query)
        settle(query)
    finally:
        query.stop()
    found = closed[0].unionByName(closed[1]).unionByName(closed[2])
    return with_window_text(found).select("step", *CITY_COLUMNS)


@query
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows from the table and open ones from the job's state: together all sales."""
    base = run_dir(spark, "open-windows")
    sales = as_sales(stream_events(spark, sf_dir))
    run_available(ranking_job(sales, "city", f"{base}/table", f"{base}/checkpoint"))
    columns = ["window_start", "window_end", "city", "total_sales", "transaction_count", "rank"]
    table = serve.latest_windows(read_rankings(spark, f"{base}/table", schemas.CITY_RANKING))
    still = top_n_per_window(open_windows.open_totals(spark, f"{base}/checkpoint", "city"), "city")
    found = table.select(*columns, F.lit(False).alias("open")).unionByName(
        still.select(*columns, F.lit(True).alias("open")))
    return with_window_text(found).select(*CITY_COLUMNS, "open")


@query
def stream_failed_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second portion's micro-batch fails after its write; the job starts again from its checkpoint.
    Every window has one version."""
    sales = read_sales(spark, sf_dir).select("event_time", "amount", "city")
    portions = _Portions(spark, "failed-commit", sales, "event_time")
    base, runs = portions.base, []

    def fail_after(rows: DataFrame, path: str) -> None:
        append_once(rows, path)
        raise ConnectionError("the job is lost between write and commit")

    def start(stream: DataFrame) -> None:
        runs.append(stream)
        if len(runs) == 2:
            with suppress(StreamingQueryException):
                run_available(ranking_job(stream, "city", f"{base}/table", f"{base}/checkpoint",
                                          write=fail_after))
        run_available(ranking_job(stream, "city", f"{base}/table", f"{base}/checkpoint",
                                  write=append_once))

    portions.run_each(start)
    table = read_rankings(spark, f"{base}/table", schemas.CITY_RANKING)
    versions = table.groupBy("window_start").agg(
        F.count_distinct("updated_at", "batch_id").alias("versions"))
    found = table.join(versions, "window_start")
    return with_window_text(found).select(*CITY_COLUMNS, "versions")


@query
def stream_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A normalization stream's own metrics, newest values: quality counters and the lag of its sources."""
    base = run_dir(spark, "stream-gauges")
    sales = read_sales(spark, sf_dir)
    for source, part in _parts(sales).items():
        number = F.pmod("event_id", F.lit(5))
        damaged = part.withColumns({
            "sale_id": F.when(number == 1, "").otherwise(F.col("sale_id")),
            "amount": F.when(number == 2, F.lit(0)).otherwise(F.col("amount")).cast("decimal(18,2)")})
        write_topic(source_records(damaged, source), f"{base}/{source}", fmt="parquet")
    topics = {source: read_topic(spark, f"{base}/{source}", fmt="parquet") for source in C.SOURCES}
    query = run_available(normalization_job(topics, f"{base}/unified", f"{base}/checkpoint", fmt="text"))
    newest = metrics.latest_gauge(progress_samples(spark, query), "series")
    return newest.where("series like 'source_lag/%' or series rlike 'observed/quality_[a-z]+/'").select(
        "series", "value")


# --- metrics on a grid of steps --------------------------------------------------------------

def _range_rate(spark: SparkSession, sf_dir: str, step: int, seconds: int) -> DataFrame:
    samples = counter_samples(spark, sf_dir)
    grid = stepping.Grid.over(samples, step)
    if grid is None:
        grid = stepping.Grid(0, 0, step)
    rated = stepping.rate_at_steps(samples, "series", grid, seconds, seq="event_id")
    return rated.select("series", times.format_window(F.col("ts")).alias("ts"), "increase", "rate")


@query
def range_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over five minutes at every minute."""
    return _range_rate(spark, sf_dir, 60, 300)


@query
def range_rate_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over six hours at every half hour."""
    return _range_rate(spark, sf_dir, 1800, 21_600)


@query
def range_latest_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest value of the last five minutes at every minute."""
    events = read_events(spark, sf_dir)
    grid = stepping.Grid.over(events, 60) or stepping.Grid(0, 0, 60)
    found = stepping.value_at_steps(events, "event_type", grid, seq="event_id")
    return found.select("event_type", times.format_window(F.col("ts")).alias("ts"), "value")


@query
def range_alert_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`alert_latency_p95` on a grid of ten minutes, "for" counted in steps."""
    samples = _request_buckets(spark, sf_dir)
    grid = stepping.Grid.over(samples, 600) or stepping.Grid(0, 0, 600)
    found = stepping.latency_alert(samples, "uri", grid, "event_id", range_seconds=21_600)
    return found.select("uri", *(times.format_window(F.col(c)).alias(c) for c in (
        "pending_since", "firing_since", "firing_to")), "steps")
