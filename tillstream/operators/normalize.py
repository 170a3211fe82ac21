"""Raw JSON records of any source to unified sales events.

Everything here is a narrow projection: no shuffle, batch or streaming alike. What can't be used
is never dropped without a trace: `quarantine`, `quarantine_unified` and `unplaceable_times` give
exactly the rows that `normalize_sales`, `read_unified` and `with_event_time` leave out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream import constants as C
from tillstream.functions.fields import (
    MALFORMED, double_needs_kind, double_of, first_present, kind_of, parse_fields,
    string_needs_kind, string_of,
)
from tillstream.functions.times import (
    current_ms, event_time_or_null, event_timestamp, integer_of, iso_to_ms, time_needs_kind,
)
from tillstream.schemas import MONEY, UNIFIED_RECORD

_STRING_FIELDS = {
    "sale_id": C.SALE_ID_ALIASES,
    "salesman_name": C.SALESMAN_ALIASES,
    "city": C.CITY_ALIASES,
    "country": C.COUNTRY_ALIASES,
    "product": C.PRODUCT_ALIASES,
}
_EVENT_COLUMNS = (
    "sale_id", "salesman_name", "city", "country", "amount", "product",
    "event_time_ms", "source", "ingestion_time_ms",
)


_ALL_NAMES = tuple(dict.fromkeys(
    name for names in (*_STRING_FIELDS.values(), C.AMOUNT_ALIASES, C.EVENT_TIME_ALIASES,
                       ("source",))
    for name in names))


_ABSENT = "absent_text"


def _with_json(records: DataFrame, value: str) -> DataFrame:
    # Exploding an array of one keeps the parse, and whatever made the text, apart from the filter
    # on the results; as plain columns they would be copied into the filter and run twice.
    parsed = F.array(F.struct(parse_fields(F.col(value), _ALL_NAMES).alias("fields"),
                              F.col(value).isNull().alias("absent")))
    found = records.select("*", F.explode(parsed).alias("json"))
    return found.select(*records.columns, F.col("json.fields").alias("json"),
                        F.col("json.absent").alias(_ABSENT))


def _readable() -> Column:
    """True for JSON of any kind, and for blank text, an empty record with all defaults."""
    text = F.col(f"json.{MALFORMED}")
    return ~F.col(_ABSENT) & (text.isNull() | F.try_parse_json(text).isNotNull())


def parse_sales_json(records: DataFrame, value: str = "value") -> DataFrame:
    """Keep the readable records and add their parsed fields as `json`."""
    return _with_json(records, value).where(_readable()).drop(_ABSENT)


def quarantine(records: DataFrame, value: str = "value") -> DataFrame:
    """The records that `parse_sales_json` leaves out: malformed JSON and NULL values."""
    return _with_json(records, value).where(~_readable()).drop("json", _ABSENT)


def normalize_sales(records: DataFrame, source: str | None = None, value: str = "value",
                    now_ms: Column | None = None, with_flags: bool = False,
                    quality: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Parse JSON text in `value` into unified sales events.

    `source` overrides the field of that name, as each topic has one source. `now_ms` is the
    processing time used for missing or unreadable event times and for the ingestion stamp.
    `with_flags` adds the data-quality flags `dq_counts` adds up. `carry` names columns of the
    input that stay.

    With a name in `quality`, the same counters are observed on the way, with the number of
    malformed records that are left out; they show up in the progress of a stream. Two inputs in
    one plan need two names.
    """
    now = current_ms() if now_ms is None else now_ms
    fields = {
        **_STRING_FIELDS,
        **({} if source is not None else {"source": ("source",)}),
        "amount": C.AMOUNT_ALIASES,
        "event_time_ms": C.EVENT_TIME_ALIASES,
    }
    parsed = _with_json(records, value)
    readable = _readable()
    if quality:
        parsed = parsed.observe(f"{quality}_read", F.count(F.lit(1)).alias("read"),
                                F.count_if(~readable).alias("malformed"))
    raw = parsed.where(readable).select(
        *carry, F.col(value).alias("record"),
        *[first_present(F.col("json"), names).alias(name) for name, names in fields.items()])
    # Read as VARIANT only the records in which the JSON type of some value matters.
    # Each value is looked at once, in columns of their own that later ones share.
    raw = raw.withColumns({"iso_ms": iso_to_ms(F.col("event_time_ms")),
                           "amount_number": F.col("amount").try_cast("double")})
    raw = raw.withColumn("time_number", F.when(
        F.col("iso_ms").isNull(), integer_of(F.col("event_time_ms"))))
    in_doubt = (
        time_needs_kind(F.col("event_time_ms"), F.col("iso_ms"), F.col("time_number"))
        | double_needs_kind(F.col("amount")))
    for name in fields:
        if name not in ("amount", "event_time_ms"):
            in_doubt = in_doubt | string_needs_kind(F.col(name))
    typed = raw.withColumn("typed", F.when(in_doubt, F.try_parse_json("record")))

    variant = F.col("typed")
    doubted = variant.isNotNull()

    def kind(name: str) -> Column:
        return kind_of(variant, fields[name])

    def string(name: str) -> Column:
        return string_of(F.col(name), kind(name), doubted).alias(name)

    # As in `_with_json`: a filter on the events would otherwise take in the whole of this.
    values = typed.select(*carry, F.inline(F.array(F.struct(
        *[string(name) for name in _STRING_FIELDS],
        double_of(F.col("amount"), kind("amount"), F.col("amount_number")).alias("amount"),
        event_time_or_null(F.col("event_time_ms"), kind("event_time_ms"), F.col("iso_ms"),
                           F.col("time_number")).alias("parsed_ms"),
        (string("source") if source is None else F.lit(source)).alias("source"),
    ))))
    events = values.select(
        *carry, "sale_id", "salesman_name", "city", "country", "amount", "product",
        F.coalesce("parsed_ms", now).alias("event_time_ms"),
        "source",
        now.alias("ingestion_time_ms"),
        *_flags(),
    )
    if quality:
        events = observe_dq(events, quality)
    return events if with_flags else events.drop(*DQ_FLAGS)


# Doubles from here on exceed the money type; the largest one below is a whole number within it.
_MONEY_LIMIT = 1e16


def _flags() -> list[Column]:
    amount = F.col("amount")
    return [
        (F.col("sale_id") == "").alias("empty_sale_id"),
        (amount == 0.0).alias("zero_amount"),
        F.col("parsed_ms").isNull().alias("time_fallback"),
        (F.isnan(amount) | (F.abs(amount) >= _MONEY_LIMIT)).alias("unstorable_amount"),
    ]


DQ_FLAGS = ("empty_sale_id", "zero_amount", "time_fallback", "unstorable_amount")


def _dq_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in DQ_FLAGS],
    ]


def dq_counts(flagged: DataFrame) -> DataFrame:
    """Data-quality counters per source; the rows themselves are all kept."""
    return flagged.groupBy("source").agg(*_dq_aggregates())


def observe_dq(flagged: DataFrame, name: str) -> DataFrame:
    """Attach the same counters as an observation, to read them off a job or a stream's progress."""
    return flagged.observe(name, *_dq_aggregates())


def unify_sources(*events: DataFrame) -> DataFrame:
    """All rows of all sources, duplicates included."""
    unified, *rest = [df.select(*_EVENT_COLUMNS) for df in events]
    for df in rest:
        unified = unified.unionByName(df)
    return unified


def with_event_time(events: DataFrame) -> DataFrame:
    """Add the TIMESTAMP `event_time`, and `amount` as money.

    Amounts the money type cannot hold (NaN, infinite, too large) count as 0.00, so that the
    row still counts as a transaction. A time that TIMESTAMP cannot hold has no window;
    `unplaceable_times` gives those rows.
    """
    return (
        events
        .where(_placeable())
        .withColumn("event_time", event_timestamp(F.col("event_time_ms")))
        .withColumn("amount", F.coalesce(
            F.col("amount").try_cast(MONEY), F.lit(0).cast(MONEY)))
    )


def _placeable() -> Column:
    return F.coalesce(event_timestamp(F.col("event_time_ms")).isNotNull(), F.lit(False))


def unplaceable_times(events: DataFrame) -> DataFrame:
    """The events that `with_event_time` leaves out: no time, or one beyond TIMESTAMP."""
    return events.where(~_placeable())


_UNREAD = "unread"
_UNIFIED_OR_TEXT = T.StructType([*UNIFIED_RECORD.fields, T.StructField(_UNREAD, T.StringType())])


def _with_unified(records: DataFrame, value: str) -> DataFrame:
    # As in `_with_json`, so that the record is parsed once.
    record = F.from_json(F.col(value), _UNIFIED_OR_TEXT, {"columnNameOfCorruptRecord": _UNREAD})
    return records.select("*", F.explode(F.array(record)).alias("r"))


def _unified_readable() -> Column:
    return F.col("r").isNotNull() & F.col(f"r.{_UNREAD}").isNull() & F.col("r.eventTime").isNotNull()


def quarantine_unified(records: DataFrame, value: str = "value") -> DataFrame:
    """The records that `read_unified` leaves out: malformed, of other types, or without a time."""
    return _with_unified(records, value).where(~_unified_readable()).drop("r")


def read_unified(records: DataFrame, value: str = "value",
                 quality: str | None = None) -> DataFrame:
    """Strict read of the unified topic: fixed names and types, no second unit inference.

    With a name in `quality`, records read and unreadable ones are counted under it.
    """
    parsed = _with_unified(records, value)
    if quality:
        parsed = parsed.observe(quality, F.count(F.lit(1)).alias("read"),
                                F.count_if(~_unified_readable()).alias("unreadable"))
    return parsed.where(_unified_readable()).select(
        F.col("r.saleId").alias("sale_id"),
        F.col("r.salesmanName").alias("salesman_name"),
        "r.city", "r.country", "r.amount", "r.product",
        F.col("r.eventTime").alias("event_time_ms"),
        "r.source",
        F.col("r.ingestionTime").alias("ingestion_time_ms"),
    )


def filter_country(df: DataFrame, country: str = C.RANKED_COUNTRY) -> DataFrame:
    """Rows of one country, in any letter case, untrimmed."""
    return df.where(F.upper("country") == country.upper())
