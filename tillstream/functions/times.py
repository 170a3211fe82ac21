"""Event times: epoch units, the lenient parse chain, and text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.functions.fields import is_fractional

# Accepted time texts. The guards matter: a plain cast to timestamp would also take a blank
# instead of `T`, a bare date, or surrounding spaces. Seconds may be missing only where a
# fraction and a zone are too.
_INTEGER = r"^[+-]?[0-9]+\z"
_ISO = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?([Zz]|[+-]\d{2}:\d{2})?)?\z"

# Milliseconds whose microseconds still fit 64 bits.
_MAX_MS = 9_223_372_036_854_775


def current_ms() -> Column:
    """Processing time in ms, one value per batch or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def infer_epoch_ms(number: Column) -> Column:
    """Integer epoch in unknown unit to ms; NULL if the result leaves 64 bits."""
    return (
        F.when(number > C.MICROS_ABOVE, F.call_function("div", number, F.lit(1000)))
        .when(number > C.MILLIS_ABOVE, number)
        .otherwise(F.try_multiply(number, F.lit(1000).cast("bigint")))
    )


# A failing cast costs an exception, and the planner may move a cast out of the branch that
# guards it. So what does not have the right form is made NULL before the cast.

def iso_to_ms(text: Column) -> Column:
    """ISO instant, or ISO local time as UTC, in ms; NULL for any other text."""
    return F.unix_millis(F.try_to_timestamp(F.when(text.rlike(_ISO), F.upper(text))))


def integer_of(text: Column) -> Column:
    """Integer text as a number; NULL for any other, and beyond 64 bits."""
    return F.when(text.rlike(_INTEGER), text).try_cast("bigint")


def text_to_ms(text: Column) -> Column:
    """Integer text as ms (no unit inference), ISO instant, or ISO local time as UTC; else NULL."""
    return (
        F.when(text.rlike(_ISO), iso_to_ms(text))
        .otherwise(integer_of(text))
    )


def _same_in_any_unit(number: Column) -> Column:
    # A number already in the range of milliseconds reads the same as a number and as text.
    return F.coalesce(infer_epoch_ms(number) == number, F.lit(False))


def time_needs_kind(text: Column, iso_ms: Column, number: Column) -> Column:
    """True where a JSON string and another value with this raw text give different times.

    `iso_ms` is `iso_to_ms(text)`, and `number` is `integer_of(text)` where that is NULL; both are
    worked out once by the caller.
    """
    other = (
        (number.isNotNull() & ~_same_in_any_unit(number))
        | text.isin("true", "false") | is_fractional(text))
    return F.when(iso_ms.isNull(), other).otherwise(F.lit(False))


def event_time_or_null(text: Column, kind: Column, iso_ms: Column, number: Column) -> Column:
    """Event time in ms of one raw value, NULL when absent or not understood.

    `iso_ms` and `number` are as in `time_needs_kind`.

    The value is already that of the first alias present, so a bad one does not fall through
    to the next alias. Integers get their unit inferred, integer texts are ms as they are,
    fractions are cut off, true is 1.
    """
    return (
        F.when(iso_ms.isNotNull(), iso_ms)
        .when(number.isNotNull(), F.when(_same_in_any_unit(number), number)
              .when(kind == "BIGINT", infer_epoch_ms(number))
              .when(kind == "STRING", number))
        .when(is_fractional(text) & (kind != "STRING"),
              F.when(is_fractional(text), text).try_cast("double").try_cast("bigint"))
        .when(text.isin("true", "false") & (kind == "BOOLEAN"),
              F.when(text == "true", 1).otherwise(0).cast("bigint"))
    )


def event_timestamp(ms: Column) -> Column:
    """TIMESTAMP of an epoch in ms; NULL beyond the range of the type."""
    return F.when(ms.between(-_MAX_MS, _MAX_MS), F.timestamp_millis(ms))


def format_window(ts: Column) -> Column:
    return F.date_format(ts, C.WINDOW_FORMAT)


def format_response_time(ts: Column) -> Column:
    return F.date_format(ts, C.RESPONSE_TIME_FORMAT)


def iso_instant(ts: Column) -> Column:
    """ISO instant with as many groups of three fraction digits as needed."""
    return F.concat(
        F.regexp_replace(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"(\.000000|000)$", ""),
        F.lit("Z"),
    )


def iso_local(ts: Column) -> Column:
    """ISO local date-time, as `iso_instant` without the zone."""
    return F.regexp_replace(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"(\.000000|000)$", "")
