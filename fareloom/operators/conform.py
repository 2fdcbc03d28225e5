"""Raw trip rows to the fixed layout of a target table, as narrow projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.names import snake_case
from fareloom.functions.values import cast_to, coerce_int, key_text, md5_key, to_money
from fareloom.schemas import FILE_NAME, KEY, MONEY, Colour


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(name) for name in df.columns])


def cast_columns(df: DataFrame, kinds: Mapping[str, T.DataType]) -> DataFrame:
    """Strict casts of the named columns, the others untouched."""
    return df.withColumns({name: cast_to(F.col(name), df.schema[name].dataType, kind) for name, kind in kinds.items()})


def trip_key(df: DataFrame, colour: Colour) -> Column:
    """The row key: md5 over vendor, times, zones, fare and distance of the raw row."""
    kinds = {field.name.lower(): field.dataType for field in df.schema.fields}
    return md5_key([key_text(F.col(part), kinds[part.lower()]) for part in colour.key_parts])


def add_key_and_file(df: DataFrame, colour: Colour, file_name: Column) -> DataFrame:
    """Key and source file in front of the raw columns."""
    rest = [F.col(f"`{name}`") for name in df.columns if name.lower() not in (KEY, FILE_NAME)]
    return df.select(trip_key(df, colour).alias(KEY), file_name.alias(FILE_NAME), *rest)


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns in its order and types.

    An absent column becomes 0 (text: '0'); a NULL that is present stays NULL, except
    that integer columns turn it, like everything that is no number, into 0.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    columns = []
    for field in target.fields:
        if field.name not in present:
            if isinstance(field.dataType, T.TimestampNTZType):
                raise ValueError(f"no column {field.name} in the source")
            value = F.lit(0).cast(field.dataType)
        elif isinstance(field.dataType, T.IntegerType):
            value = coerce_int(F.col(field.name), present[field.name])
        elif field.dataType == MONEY:
            value = to_money(F.col(field.name))
        else:
            value = F.col(field.name).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def conform(df: DataFrame, colour: Colour, file_name: Column) -> DataFrame:
    """Key, lineage, snake_case names, alignment and types, in one projection chain."""
    return align(snake_case_columns(add_key_and_file(df, colour, file_name)), colour.target)
