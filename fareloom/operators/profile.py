"""Counts and profiles of a whole table in one pass."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.names import month_file_of


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _missing(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values (NULL, and NaN in floating columns) per column, one row each."""
    return table_profile(df).select("column_name", "null_count")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: place, name, type, missing values, and the table's row count."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(_missing(field)).alias(f"c{i}") for i, field in enumerate(fields)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("null_count"),
            )
            for i, field in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows), F.col("n").alias("row_count"))


#: Types whose bounds Parquet files keep reliably in their footers.
_BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def footer_aggregates(spark: SparkSession, *paths: str, pushed: bool = True) -> DataFrame:
    """One row over some Parquet files: ``n`` rows, and by place of the column ``c0`` values, ``l0`` least, ``h0`` largest.

    The aggregates are pushed into the scan, which reads footers and no column.
    """
    reader = spark.newSession()
    # The source that takes aggregates, in a session of its own: other readers keep theirs.
    listed = [name for name in reader.conf.get("spark.sql.sources.useV1SourceList").split(",") if name != "parquet"]
    reader.conf.set("spark.sql.sources.useV1SourceList", ",".join(listed))
    reader.conf.set("spark.sql.parquet.aggregatePushdown", str(pushed).lower())
    scan = reader.read.parquet(*paths)
    asked = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(scan.schema.fields):
        column = F.col(f"`{field.name}`")
        asked.append(F.count(column).alias(f"c{i}"))
        if isinstance(field.dataType, _BOUNDED):
            asked += [F.min(column).alias(f"l{i}"), F.max(column).alias(f"h{i}")]
    return scan.agg(*asked)


def footer_profile(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per column of some Parquet files: values that are no NULL, least and largest whole number, and rows.

    All of it comes from the files' footers, unless a file's column holds NULL only: then there are no
    bounds in its footer, and the columns are read. Bounds of other types than whole numbers, dates (days since
    1970) and truth values are NULL. NaN is a value here.
    """
    fields = spark.read.parquet(*paths).schema.fields
    try:
        found = footer_aggregates(spark, *paths).first().asDict()
    except Exception as failure:
        if "No min/max found" not in str(failure):
            raise
        found = footer_aggregates(spark, *paths, pushed=False).first().asDict()

    def bound(letter: str, i: int) -> int | None:
        value = found.get(f"{letter}{i}")
        return value.toordinal() - date(1970, 1, 1).toordinal() if isinstance(value, date) else value if value is None else int(value)

    rows = [(field.name, found[f"c{i}"], bound("l", i), bound("h", i), found["n"]) for i, field in enumerate(fields)]
    return spark.createDataFrame(rows, "column_name string, value_count bigint, least bigint, largest bigint, row_count bigint")


def rows_per_file(scan: DataFrame) -> DataFrame:
    """Row count of every month file in a multi-file scan."""
    name = month_file_of(F.col("_metadata.file_path"))
    return scan.groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("n"))
