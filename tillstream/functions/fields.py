"""Lenient reads of one field of a JSON record.

`parse_fields` reads a record once, into the raw text of each known field. A field is looked
up under several names; the first that is present and not JSON null decides. Raw text leaves
out one thing, whether a value was a JSON string: `"5"` and `5` look alike. Where that can
matter at all, and only there, the record is read again as VARIANT to tell (`kind_of`). Values
never fail a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MALFORMED = "malformed_text"

# JSON numbers with a fraction or an exponent, as raw text.
_FRACTIONAL = r"^-?\d+(\.\d+([eE][+-]?\d+)?|[eE][+-]?\d+)\z"

# Special values the cast to double takes under more spellings than it should.
_SPECIAL = r"(?i)^[\x00-\x20]*[+-]?(nan|inf|infinity)[\x00-\x20]*\z"
_SPECIAL_EXACT = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*\z"


def parse_fields(text: Column, names: Sequence[str]) -> Column:
    """Struct with the raw text of each name, and the whole text where it is no JSON object.

    One pass over the text, in which unknown fields are skipped. A repeated name takes its
    last value. Quotes and numbers must be as the JSON grammar has them.
    """
    columns = ", ".join(f"`{name}` STRING" for name in (*names, MALFORMED))
    return F.from_json(text, columns, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
        "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
    })


def first_present(json: Column, names: Sequence[str]) -> Column:
    """Raw text of the first alias that is present and not JSON null, else NULL."""
    return F.coalesce(*[json[name] for name in names])


def kind_of(variant: Column, names: Sequence[str]) -> Column:
    """JSON type of the same alias in a VARIANT of the record.

    One of BIGINT, STRING, DECIMAL(p,s), DOUBLE, BOOLEAN, OBJECT<..>, ARRAY<..>.
    """
    nodes = [F.try_variant_get(variant, f"$.{name}", "variant") for name in names]
    return F.schema_of_variant(
        F.coalesce(*[F.when(~F.is_variant_null(node), node) for node in nodes]))


def is_fractional(text: Column) -> Column:
    return text.rlike(_FRACTIONAL)


def string_needs_kind(text: Column) -> Column:
    """True where a JSON string and another value with this raw text give different strings."""
    # `-`, `.`, `/` and the digits are what sorts from `-` up to, but not including, `:`.
    maybe_number = (text >= "-") & (text < ":")
    return (
        text.startswith("{") | text.startswith("[")
        | (maybe_number & (is_fractional(text) | (text == "-0")))
    )


def string_of(text: Column, kind: Column, in_doubt: Column | None = None) -> Column:
    """Scalar as text; '' for objects, arrays and absent fields.

    Numbers with a fraction or exponent print as doubles do: `1e3` as `1000.0`. `in_doubt`, if
    the caller has it at hand, is true at least where `string_needs_kind` is.
    """
    fractional = is_fractional(text)
    doubt = string_needs_kind(text)
    return (
        F.when(text.isNull(), "")
        .when(~doubt if in_doubt is None else ~(in_doubt & doubt), text)
        .when(kind == "STRING", text)
        .when(text == "-0", "0")
        .when(fractional, F.when(fractional, text).try_cast("double").cast("string"))
        .otherwise("")
    )


def double_needs_kind(text: Column) -> Column:
    return text == "true"


def double_of(text: Column, kind: Column, number: Column) -> Column:
    """Number as double, text parsed as double, true as 1.0; 0.0 for all else.

    `number` is the text cast to double, worked out once by the caller.
    """
    return F.when(double_needs_kind(text) & (kind == "BOOLEAN"), F.lit(1.0)).otherwise(
        text_to_double(text, number))


def text_to_double(text: Column, number: Column) -> Column:
    """Text parsed as double, 0.0 where that fails.

    Special values must be spelled `NaN` or `Infinity`, with an optional sign.
    """
    # Zero for finite numbers alone, so only the rest pays for the look at the text.
    finite = number - number == 0.0
    return (
        F.when(finite, number)
        .when(text.rlike(_SPECIAL_EXACT) & text.contains("NaN"), F.lit(float("nan")))
        .when(number.isNull() | (text.rlike(_SPECIAL) & ~text.rlike(_SPECIAL_EXACT)), F.lit(0.0))
        .otherwise(F.coalesce(number, F.lit(0.0)))
    )
