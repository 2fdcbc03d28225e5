"""Column expressions for text keys, lenient numbers and strict casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.schemas import MISSING_TOKENS, MONEY

# Texts that stand for a missing part of the row key (fixed values).
MISSING_INTEGER, MISSING_FLOAT, MISSING_TIME = "<NA>", "nan", "NaT"

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def float_text(value: Column) -> Column:
    """A double as text: plain from 1e-4 up to 1e16, with a two-digit exponent outside.

    Spark itself switches to ``1.0E7`` at 1e7 and to ``1.0E-4`` below 1e-3, so only
    those rare texts are laid out anew.
    """
    value = value.cast("double")
    size = F.abs(value)
    text = value.cast("string")
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), _without_exponent(value))
        .otherwise(_with_exponent(text))
    )


def _without_exponent(value: Column) -> Column:
    """Through a decimal wide enough for all digits of a double between 1e-4 and 1e16."""
    digits = F.rtrim(value.cast("decimal(38,20)").cast("string"), F.lit("0"))
    return F.concat(digits, F.when(digits.endswith("."), "0").otherwise(""))


def _with_exponent(text: Column) -> Column:
    """``1.0E16`` as 1e+16, ``1.5E-7`` as 1.5e-07, ``NaN`` and ``Infinity`` as nan and inf."""
    small = F.lower(F.replace(F.replace(text, F.lit("Infinity"), F.lit("inf")), F.lit(".0E"), F.lit("E")))
    return F.regexp_replace(F.regexp_replace(small, "e([0-9])", "e+$1"), "e(.)([0-9])$", "e$10$2")


def key_text(column: Column, kind: T.DataType) -> Column:
    """Text of one key part; a missing value gets a fixed token, so the key is never NULL."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(float_text(column), F.lit(MISSING_FLOAT))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.coalesce(column.cast("timestamp_ntz").cast("string"), F.lit(MISSING_TIME))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(column.cast("string"), F.lit(MISSING_INTEGER))
    return F.coalesce(column.cast("string"), F.lit(MISSING_FLOAT))


def md5_key(parts: list[Column]) -> Column:
    """md5 over the joined part texts. No separator, so distinct rows can share a key in principle."""
    return F.md5(F.concat(*parts))


def coerce_int(column: Column, kind: T.DataType) -> Column:
    """Any value as INT: fractions are cut off, what is no number becomes 0.

    A number outside the INT range stays an error (the outer cast is not lenient).
    """
    if isinstance(kind, T.IntegralType):
        return F.coalesce(column.cast("int"), F.lit(0))
    if isinstance(kind, T.StringType):
        number = F.when(column.rlike(NUMBER), F.trim(column).try_cast("double"))
    else:
        number = column.cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)).cast("int"), F.lit(0))


def to_money(column: Column) -> Column:
    """Two exact decimals, halves away from zero; NaN becomes NULL, overflow is an error."""
    return column.cast(MONEY)


def strict_long(column: Column, kind: T.DataType) -> Column:
    """Cast to BIGINT that refuses fractions: ``1.0`` is 1, ``1.5`` is an error."""
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    number = column.cast("double")
    checked = F.when(F.isnan(number), None).when(number == F.floor(number), number.cast("bigint"))
    refused = F.raise_error(F.concat(F.lit("not an integer: "), column.cast("string"))).cast("bigint")
    checked = F.when(number.isNotNull(), checked.otherwise(refused))
    if isinstance(kind, T.StringType):
        # Plain digits go straight to BIGINT: a double would round long ones. A failing
        # try_cast would do as well, but it costs an exception per row.
        return F.when(column.rlike("[.eE]"), checked).otherwise(column.cast("bigint"))
    return checked


def cast_to(column: Column, kind: T.DataType, target: T.DataType) -> Column:
    """Strict cast by target type."""
    if isinstance(target, T.IntegralType):
        return strict_long(column, kind).cast(target)
    return column.cast(target)


def missing_to_null(column: Column) -> Column:
    return F.when(~column.isin(*MISSING_TOKENS), column)
