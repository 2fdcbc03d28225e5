"""Scans of trip and zone files."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.names import month_file_name
from fareloom.functions.values import cast_to, missing_to_null
from fareloom.operators.conform import cast_columns
from fareloom.operators.ordering import placed
from fareloom.schemas import RAW_GREEN_CASTS, RAW_YELLOW, ZONE_LOOKUP
from fareloom.session import file_system, path_exists, setting

T_ = TypeVar("T_")

# Looks at single files, each a small job of its own, that run side by side.
FILE_LOOKS = 16

# A quote inside a quoted text is doubled; a backslash is a letter like any other.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def scan_csv(spark: SparkSession, *paths: str, multi_line: bool = False, same_header: bool = True) -> DataFrame:
    """Headed CSV files as they are; files whose header differs from the first one's are an error.

    ``same_header=False`` admits them where columns do not matter, as in a row count.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("enforceSchema", not same_header)
    return reader.csv(list(paths))


def side_by_side(look: Callable[[str], T_], paths: Iterable[str]) -> list[T_]:
    """One look at each path, many at a time, in the order of the paths."""
    with ThreadPoolExecutor(FILE_LOOKS) as pool:
        return list(pool.map(look, paths))


def read_csv_text(
    spark: SparkSession, *paths: str, multi_line: bool = False, with_places: bool = False
) -> DataFrame:
    """Headed CSV (or .csv.gz) as text columns, found by name; missing-value tokens are NULL.

    Paths with the same header are read together, others are put together by column name.
    A gzip file cannot be split, so one file is one task; spread the rows afterwards
    (``spread_rows``) when few files feed heavy work. ``multi_line`` admits line breaks
    inside quotes and makes every file one task. ``with_places`` adds what numbers the rows.
    """
    frames = []
    for group in files_by_header(spark, paths):
        scan = scan_csv(spark, *group, multi_line=multi_line)
        header = scan.columns
        scan = placed(scan) if with_places else scan
        frames.append(scan.withColumns({name: missing_to_null(F.col(f"`{name}`")) for name in header}))
    return union_all(frames)


def _first_row():
    """The first row of a task; the rest of its input is not asked for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    return run


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The text files below some paths, grouped by their first line, in the order of the paths.

    One job, however many files there are: each is a task of its own that stops after its first rows. Only
    the groups come to the driver, as it needs the names of files anyway. Files without a line are left out.
    """
    if len(paths) == 1:
        system, place = file_system(spark, paths[0])
        if system.exists(place) and system.getFileStatus(place).isFile():
            return [[paths[0]]]
    looks = spark.newSession()
    # A file as large as a partition may be, so that no two share one and none is cut.
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        looks.conf.set(f"spark.sql.files.{setting}", str(1 << 50))
    lines = looks.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))
    firsts = lines.mapInArrow(_first_row(), "value string, path string")
    groups = firsts.groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    ranks = {_plain(path): rank for rank, path in reversed(list(enumerate(paths)))}

    def named(found: str) -> tuple[int, str]:
        path = as_path(spark._jvm.java.net.URI(found))
        own, above = _plain(path.toString()), _plain(path.getParent().toString())
        return ranks.get(own, ranks.get(above, len(paths))), path.toString()

    found = [sorted(named(path) for path in group.paths) for group in groups]
    # With one header, or none, the paths are read as they are given, folders of partitions included.
    return [[path for _, path in group] for group in sorted(found)] if len(found) > 1 else [list(paths)]


def _plain(path: str) -> str:
    """A path without its scheme and host."""
    return "/" + re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", path).strip("/")


def check_headers(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> None:
    """An error unless the header of each CSV file names the columns of ``schema``, in their order.

    One job, a task per file that stops at its first row. The check is that of Spark's reader.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", False)
    # No two files, or pieces of one, share a task.
    with setting(spark, "spark.sql.files.openCostInBytes", str(1 << 50)):
        reader.csv([path_of(spark, path) for path in paths]).limit(1).write.format("noop").mode("overwrite").save()


def path_of(spark: SparkSession, found: str) -> str:
    """The path that a file's metadata spell as a URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(found)).toString()


def csv_lines(value: Column, schema: T.StructType) -> Column:
    """A struct of text columns from a line of a CSV file, read as the file would be."""
    names = ["`" + name.replace("`", "``") + "`" for name in schema.names]
    return F.from_csv(value, ", ".join(f"{name} STRING" for name in names), {**CSV_OPTIONS, "header": "false"})


def typed_text(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns under explicit types, found by name, in their own order.

    Integer columns accept ``1.0`` and refuse ``1.5``. Columns outside the schema stay as they are.
    """
    kinds = {field.name: field.dataType for field in schema.fields}
    return text.select(
        *[
            cast_to(F.col(f"`{name}`"), T.StringType(), kinds[name]).alias(name) if name in kinds else F.col(f"`{name}`")
            for name in text.columns
        ]
    )


def read_csv(
    spark: SparkSession, schema: T.StructType, *paths: str, multi_line: bool = False, with_places: bool = False
) -> DataFrame:
    """A headed CSV under explicit types, columns matched by name and in file order."""
    return typed_text(read_csv_text(spark, *paths, multi_line=multi_line, with_places=with_places), schema)


_DIGITS = r"^\s*[+-]?[0-9]+\s*$"
# The types a CSV column may turn out to have, narrowest first, and the texts that fit each. Whole numbers
# never become doubles, which would round them: those too long for a decimal stay text.
_INFERRED = {
    "bigint": _DIGITS,
    "decimal(38,0)": _DIGITS,
    "string": _DIGITS,
    "double": r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$",
    "boolean": r"^(?i:true|false)$",
    "timestamp_ntz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$",
}


def _fits(value: Column, kind: str, pattern: str) -> Column:
    """Whether a text fits a type, NULL for NULL; whole numbers must lie in its range as well."""
    if pattern != _DIGITS:
        return value.rlike(pattern)
    return value.rlike(pattern) & (F.trim(value).try_cast(kind).isNotNull() | value.isNull())


def read_inferred_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """A headed CSV with types found by one pass over the data.

    A column has the narrowest type that all its values fit; missing-value tokens are NULL and
    fit any. What fits none, or holds no value at all, stays text.
    """
    text = read_csv_text(spark, *paths)
    fits = [
        F.bool_and(_fits(F.col(f"`{name}`"), kind, pattern)).alias(f"{i} {kind}")
        for i, name in enumerate(text.columns)
        for kind, pattern in _INFERRED.items()
    ]
    found = text.agg(*fits).first().asDict()
    columns = []
    for i, name in enumerate(text.columns):
        kind = next((kind for kind in _INFERRED if found[f"{i} {kind}"]), "string")
        value = F.col(f"`{name}`")
        columns.append((F.trim(value) if kind in ("bigint", "decimal(38,0)", "double") else value).cast(kind).alias(name))
    return text.select(*columns)


def read_yellow_csv(spark: SparkSession, *paths: str, with_places: bool = False) -> DataFrame:
    return read_csv(spark, RAW_YELLOW, *paths, with_places=with_places)


def read_green_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    raw = read_parquet(spark, *paths)
    return cast_columns(raw, {name: kind for name, kind in RAW_GREEN_CASTS.items() if name in raw.columns})


def read_zones_csv(spark: SparkSession, *paths: str) -> DataFrame:
    return read_csv(spark, ZONE_LOOKUP, *paths)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows of few unsplittable files over partitions of even size."""
    return df.hint("rebalance")


def month_path(prefix: str, colour: str, year: int, month: int, extension: str = "parquet") -> str:
    """Where a month lies: the prefix (with its closing separator) and the file name."""
    return prefix + month_file_name(colour, year, month, extension)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet scan, or None for an absent path; every other failure is raised."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def present_months(
    spark: SparkSession, prefix: str, colour: str, months: Iterable[tuple[int, int]], extension: str = "csv.gz"
) -> list[str]:
    """Paths of the month files that exist."""
    paths = [month_path(prefix, colour, year, month, extension) for year, month in months]
    there = side_by_side(lambda path: path_exists(spark, path), paths)
    return [path for path, found in zip(paths, there) if found]


def read_months(
    spark: SparkSession, prefix: str, colour: str, months: Iterable[tuple[int, int]]
) -> tuple[list[DataFrame], list[str]]:
    """Scans of all months that exist, one for each file layout, and the names of absent months.

    Months whose files have the same columns and types are read together. Layouts
    differ over the years, so the caller aligns each scan before the union. The footers
    are looked at side by side, since each look is a small job of its own.
    """
    months = list(months)
    paths = [month_path(prefix, colour, year, month) for year, month in months]
    found = side_by_side(lambda path: read_if_present(spark, path), paths)
    by_layout: dict[str, list[str]] = defaultdict(list)
    for path, scan in zip(paths, found):
        if scan is not None:
            by_layout[scan.schema.json()].append(path)
    absent = [month_file_name(colour, *month) for month, scan in zip(months, found) if scan is None]
    scans = [
        spark.read.schema(T.StructType.fromJson(json.loads(layout))).parquet(*paths)
        for layout, paths in by_layout.items()
    ]
    return scans, absent


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that one side lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
