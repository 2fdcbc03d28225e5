"""Intermediate tables in the shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import scratch_path

# A row's place in the files it was read from: the same however often it is read. The file is
# known by the 64-bit hash of its path, which two of a million files share with a chance of
# less than one in ten million.
FILE, ROW = "_placed_file", "_placed_row"
PLACE = (FILE, ROW)
# Steps of a plan that hand on a file's rows one by one.
_PLAIN = {"LogicalRelation", "Filter", "Project", "SubqueryAlias"}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """The intermediate tables of one operator call, below a folder of their own.

    ``drop`` removes a table once nothing lazy reads it any more. What a lazy result still
    reads stays until ``drop_all``, which the caller may run after saving that result.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.held: list[tuple[DataFrame, str]] = []
        self.places: list[DataFrame] = []

    def path(self, label: str) -> str:
        return f"{self.root}/{len(self.held):03d}-{label}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """The frame written down and read from there."""
        path = self.path(label)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table, path in self.held:
            if any(table is one for one in tables):
                remove(self.spark, path)

    def drop_all(self) -> None:
        remove(self.spark, self.root)

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with each row's place.

        A row of a file has a place of its own only if nothing makes several rows of it or leaves to chance
        which rows there are; any other frame is written down first. A frame that is placed already is returned as it is.
        """
        if any(df is one for one in self.places):
            return df
        if _is_plain_scan(df):
            try:
                found = df.select("*", F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
                self.places.append(found)
                return found
            except AnalysisException:
                pass  # files without row numbers
        return self.placed(self.write(df, "rows"))

    def texts(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """A row per row: its place, ``_id`` (long) and ``_text`` (string)."""
        narrow = [F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")]
        if any(df is one for one in self.places):
            return df.select(*PLACE, *narrow)
        return self.placed(df.select(*narrow)).select(*PLACE, "_id", "_text")


def apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame under column names that clash with none an operator uses, and what each is called there."""
    inner = df.toDF(*[f"given_{i}" for i in range(len(df.columns))])
    return inner, dict(zip(df.columns, inner.columns, strict=True))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever the case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _is_plain_scan(df: DataFrame) -> bool:
    """Whether the frame is files, filtered and projected, with the same outcome at every reading."""

    def plain(node) -> bool:
        if node.getClass().getSimpleName() not in _PLAIN:
            return False
        children = node.children()
        return all(plain(children.apply(i)) for i in range(children.size()))

    plan = df._jdf.queryExecution().analyzed()
    return plan.deterministic() and plain(plan)
