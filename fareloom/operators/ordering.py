"""Top-n, full sorts and row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import materialise

_ID, _PART, _START, _FIRST = "_id", "_part", "_start", "_first_id"
FILE, BLOCK = "_file", "_block"
# monotonically_increasing_id keeps the place inside a partition in its low bits.
_POSITION_BITS = 33


def top_n(df: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    """The n largest by one column, NULL first, ties broken by further columns ascending."""
    return df.orderBy(F.col(by).desc_nulls_first(), *[F.col(tie).asc_nulls_last() for tie in ties]).limit(n)


def preview(df: DataFrame, n: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The first n rows, of a given order if there is one."""
    return (df.orderBy(*[F.col(name).asc_nulls_last() for name in by]) if by else df).limit(n)


def sort_by(df: DataFrame, *order: str) -> DataFrame:
    """Full ascending sort, missing values last.

    A value that very many rows share is cut into several ranges only if a further column of
    the order tells those rows apart; a row number kept from the scan does.
    """
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in order])


def placed(scan: DataFrame) -> DataFrame:
    """A plain file scan with each row's file, block and a number that grows within the block."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(_ID),
    )


def with_row_ids(rows: DataFrame) -> DataFrame:
    """Rows that carry file and block already, with the number that grows within the block."""
    return rows.withColumn(_ID, F.monotonically_increasing_id())


def _plain_path(path: str) -> str:
    """A path without its scheme and host, as the files below it are compared."""
    return "/" + urlsplit(path).path.strip("/")


def number_file_rows(scan: DataFrame, name: str = "index", paths: Sequence[str] = ()) -> DataFrame:
    """File rows with a 0-based gapless number that runs on in the order of the given paths.

    ``scan`` is a plain file scan, or scans made ``placed`` and put together. Files below one
    path, or all files if no paths are given, follow by name.

    Parquet files number their rows themselves, and their footers tell how many there are: only one number per
    file is added, and no row is written. Rows of other files are written down once with their
    places, and only what was written is counted; how the files were cut, and
    whether they would be cut like that again, does not matter.

    Running sums go over the blocks of a file, and over one row per file in a single task.
    """
    if FILE not in scan.columns:
        try:
            rows = scan.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(_ID))
        except AnalysisException:
            return number_file_rows(placed(scan), name, paths)
        sizes = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("_rows"))
        offsets = materialise(_rows_before(sizes, paths), "row-offsets")
        columns = [F.col(f"`{column}`") for column in scan.columns]
        return rows.join(offsets, FILE).select((F.col("_before") + F.col(_ID)).alias(name), *columns)
    rows = materialise(scan, "placed")
    blocks = rows.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_rows"), F.min(_ID).alias(_FIRST))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_in_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    files = _rows_before(blocks.groupBy(FILE).agg(F.sum("_rows").alias("_rows")), paths)
    offsets = starts.join(files, FILE).select(FILE, BLOCK, (F.col("_before") + F.col("_in_file") - F.col(_FIRST)).alias(_START))
    columns = [column for column in rows.columns if column not in (FILE, BLOCK, _ID)]
    joined = rows.join(materialise(offsets, "row-offsets"), [FILE, BLOCK])
    return joined.select((F.col(_START) + F.col(_ID)).alias(name), *[F.col(f"`{column}`") for column in columns])


def _rows_before(files: DataFrame, paths: Sequence[str]) -> DataFrame:
    """For each file, of ``_rows`` rows, how many rows the files before it have."""
    files = files.withColumn("_rank", F.lit(0))
    if paths:
        ranks = files.sparkSession.createDataFrame(
            [(_plain_path(path), rank) for rank, path in reversed(list(enumerate(paths)))], "_path string, _r int"
        ).groupBy("_path").agg(F.min("_r").alias("_r"))
        own = F.url_decode(F.regexp_replace(FILE, "^[a-zA-Z0-9+.-]+:(//[^/]*)?/*", "/"))
        above = F.regexp_replace("_own", "/[^/]*$", "")
        files = (
            files.drop("_rank").withColumn("_own", own).withColumn("_above", above)
            .join(ranks.select(F.col("_path").alias("_own"), F.col("_r").alias("_file_rank")), "_own", "left")
            .join(ranks.select(F.col("_path").alias("_above"), F.col("_r").alias("_folder_rank")), "_above", "left")
            .withColumn("_rank", F.coalesce("_file_rank", "_folder_rank", F.lit(len(paths))))
        )
    earlier = Window.orderBy("_rank", FILE).rowsBetween(Window.unboundedPreceding, -1)
    return files.select(FILE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def number_sorted_rows(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Rows numbered from 0 in a total order: one sort, written once with the places it gave."""
    columns = df.columns
    rows = materialise(sort_by(df, *order).withColumn(_ID, F.monotonically_increasing_id()), "sorted")
    parted = rows.withColumn(_PART, F.shiftright(_ID, _POSITION_BITS))
    sizes = parted.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per sorted range in a single task.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(_START))
    place = F.col(_ID).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    joined = parted.join(materialise(starts, "row-offsets"), _PART)
    return joined.select((F.col(_START) + place).alias(name), *[F.col(f"`{column}`") for column in columns])
