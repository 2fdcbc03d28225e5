"""Catalog tables: create, replace, append, empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fareloom.session import file_system, path_exists, remove_path


#: Folder of a table's load log, see ``publish``.
LOAD_LOG = "_loads"


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    recover: bool = True,
) -> None:
    """A typed parquet table, unless it is there already.

    A location that holds partitions, written when another catalog knew the table, is
    taken over with its rows, unless ``recover`` is off.
    """
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    layout = f" PARTITIONED BY ({', '.join(f'`{column}`' for column in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{place}")
    if recover and partition_by and location and path_exists(spark, location):
        spark.catalog.recoverPartitions(name)


def replace_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """The table holds exactly these rows, whatever it held before."""
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def replace_empty(df: DataFrame, name: str, location: str | None = None) -> None:
    """An empty table with the frame's columns."""
    replace_table(df.limit(0), name, location)


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Rows added by column name, in one distributed write."""
    df.write.mode("append").format("parquet").partitionBy(*partition_by).saveAsTable(name)


def table_location(spark: SparkSession, name: str) -> str:
    """Where the files of a table lie."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return told.first()["data_type"].rstrip("/")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows, of managed tables and of tables with a location of their own.

    Files and partitions go; no session setting is touched, so other loads are not disturbed.
    A load log goes first, so that no row comes back, and an index of keys with it.
    """
    location = table_location(spark, name)
    if path_exists(spark, f"{location}/{LOAD_LOG}"):
        spark.sql(f"DROP TABLE IF EXISTS {name}__keys")
        remove_path(spark, f"{location}/{LOAD_LOG}")
    system, place = file_system(spark, location)
    for found in system.listStatus(place) if system.exists(place) else []:
        if not found.getPath().getName().startswith(("_", ".")):
            system.delete(found.getPath(), True)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 5000, **options: str) -> None:
    """Rows added to a database table, in multi-row batches from every partition."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_rows), **options
    ).save()
