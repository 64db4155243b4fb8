"""Lenient number reading.

Feeds carry numbers as JSON numbers, quoted text or booleans.  Each builder
takes the column and its Spark type and picks one expression for that type, so
typed columns never pay for the general case.  Unreadable input gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions.staging import bind
from forecourt.functions.text import strip_space

_INT_TEXT = r"^[+-]?[0-9](_?[0-9])*$"
_FLOAT_TEXT = (
    r"(?i)^[+-]?(([0-9](_?[0-9])*)?\.[0-9](_?[0-9])*|[0-9](_?[0-9])*\.?)(e[+-]?[0-9](_?[0-9])*)?$"
)
_FLOAT_WORD = r"(?i)^[+-]?(nan|inf|infinity)$"
_PLAIN_FLOAT = r"^ *([0-9]+(?:\.[0-9]+)?) *$"


def _plain_digits(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def int_from_text(text: Column) -> Column:
    """`' 12 '` -> 12, `'1_000'` -> 1000, `'12.0'` -> NULL, out of INT range -> NULL."""
    # Almost every number passes the plain cast; only the rest is looked at closely.  Bound, that
    # part keeps the code generated for a row short: Java compiles no method of more than 8,000 bytes.
    return F.coalesce(text.try_cast("int"), bind(strip_space(text), lambda clean: F.when(
        clean.rlike(_INT_TEXT), _plain_digits(clean).try_cast("int"))))


def float_from_text(text: Column) -> Column:
    """Decimal or exponent notation, `nan`, `inf`; type suffixes such as `1d` give NULL."""

    def careful(clean: Column) -> Column:
        word = F.lower(F.regexp_replace(clean, "^[+-]", ""))
        special = F.when(word == "nan", F.lit(float("nan"))).when(
            clean.startswith("-"), F.lit(float("-inf"))
        ).otherwise(F.lit(float("inf")))
        return F.when(clean.rlike(_FLOAT_TEXT), _plain_digits(clean).try_cast("double")).when(
            clean.rlike(_FLOAT_WORD), special)

    plain = F.regexp_extract(text, _PLAIN_FLOAT, 1).try_cast("double")
    return F.coalesce(plain, bind(strip_space(text), careful))


def _variant(value: Column, from_text, from_number, from_bool) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", from_text(F.try_variant_get(value, "$", "string")))
        .when(kind == "BOOLEAN", from_bool(F.try_variant_get(value, "$", "boolean")))
        .when(
            kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"),
            from_number(F.try_variant_get(value, "$", "double")),
        )
    )


def _by_type(value: Column, dtype: T.DataType, from_text, from_number, from_bool) -> Column:
    if isinstance(dtype, T.StringType):
        return from_text(value)
    if isinstance(dtype, T.BooleanType):
        return from_bool(value)
    if isinstance(dtype, T.NumericType):
        return from_number(value)
    if isinstance(dtype, T.VariantType):
        return _variant(value, from_text, from_number, from_bool)
    if isinstance(dtype, T.NullType):
        return from_text(value.cast("string"))
    raise TypeError(f"cannot read numbers from a {dtype.simpleString()} column")


def read_int(value: Column, dtype: T.DataType) -> Column:
    """Whole number; a fraction is cut off, but only when it comes as a number."""
    return _by_type(
        value, dtype,
        int_from_text,
        lambda n: F.when(F.isnan(n.cast("double")), None).otherwise(n.try_cast("int")),
        lambda b: b.cast("int"),
    )


def read_float(value: Column, dtype: T.DataType) -> Column:
    return _by_type(
        value, dtype, float_from_text, lambda n: n.cast("double"), lambda b: b.cast("double")
    )


def is_set(value: Column, dtype: T.DataType) -> Column:
    """True when present and neither empty text, zero nor false; never NULL."""
    seen = _by_type(value, dtype, lambda s: s != "", lambda n: n != 0, lambda b: b)
    return F.coalesce(seen, F.lit(False))


def read_flag(value: Column, dtype: T.DataType) -> Column:
    """Three-state flag: NULL stays NULL, anything else follows `is_set`.

    The text `'false'` is set: only empty text is not.
    """
    return _by_type(value, dtype, lambda s: s != "", lambda n: n != 0, lambda b: b)


def optional_int(value: Column, dtype: T.DataType) -> Column:
    """NULL for missing, empty or zero; else the whole number (NULL when unreadable)."""
    return F.when(is_set(value, dtype), read_int(value, dtype))


def int_with_unit(text: Column, unit: str) -> Column:
    """`'471 CC'` -> 471 with unit CC; anything but bare digits beside the unit -> NULL."""
    digits = strip_space(F.replace(F.upper(text), F.lit(unit.upper()), F.lit("")))
    return F.regexp_extract(digits, "^[0-9]+$", 0).try_cast("int")


def european_price(text: Column) -> Column:
    """`'6.990,50 €'` -> 6990.5; missing or unreadable -> 0.0."""
    plain = F.translate(F.replace(text, F.lit("&nbsp;"), F.lit("")), ",.€", ".")
    return F.coalesce(float_from_text(plain), F.lit(0.0))
