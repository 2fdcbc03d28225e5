"""File sinks: parquet, headed CSV, and tab-separated text for bulk loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareloom.session import setting, shuffles_freed

# Text form of a bulk-load file (fixed values).
TAB, NULL_TEXT = "\t", "\\N"

# Spark's CSV writer trims texts and cuts times to milliseconds unless told otherwise.
_KEEP_VALUES = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "escape": '"',
}
_TSV = {**_KEEP_VALUES, "sep": TAB, "nullValue": NULL_TEXT, "header": "false"}


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together before a partitioned write.

    Keeps the file count near (values + bytes / target size) instead of (tasks x values).
    The rebalance splits a value that holds far more rows than the others.
    """
    return df.hint("rebalance", *by) if by else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    with shuffles_freed(df.sparkSession):
        gathered(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


# Files that a task has open side by side; rows of further partition values are sorted first.
_OPEN_FILES = 32
# Tasks per core that the values of whole files are dealt to, so that two long ones seldom meet in one.
_DEALT = 16


def write_csv_gz(df: DataFrame, path: str, header: bool = True, partition_by: Sequence[str] = (), whole: bool = False) -> None:
    """Gzip CSV files. ``whole``: all rows of a partition value in one file, however many they are."""
    spark = df.sparkSession
    rows = df.repartition(_DEALT * spark.sparkContext.defaultParallelism, *partition_by) if whole else gathered(df, partition_by)
    writer = rows.write.partitionBy(*partition_by).options(**_KEEP_VALUES).option("header", header).option("compression", "gzip")
    with shuffles_freed(spark):
        if not whole:
            writer.csv(path)
            return
        # A task with a long value need not sort, and spill, what it writes.
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(_OPEN_FILES)):
            writer.csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text without a header; NULL is ``\\N``, an empty text a quoted pair."""
    df.write.options(**_TSV).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """What ``write_tsv`` wrote, columns by position; a malformed line is an error.

    ``multi_line`` is needed where texts hold line breaks, and makes a file one task.
    """
    reader = spark.read.schema(schema).options(**_TSV).option("mode", "FAILFAST")
    return reader.option("multiLine", multi_line).csv(path)
