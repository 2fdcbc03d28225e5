"""Trips and zones as views over the order tables used for checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.names import month_file_column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    regions = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("borough"))
    return nation.join(regions, "n_regionkey").select(
        F.col("n_nationkey").alias("location_id"), "borough", F.col("n_name").alias("zone")
    )


def trips(spark: SparkSession, sf_dir: str, row: str | None = None) -> DataFrame:
    """One trip per order line; amounts are whole cents, as in trip files.

    Orders meet customers before they meet the much longer lines. ``row`` names a further column
    with the line's place in its file.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    price, discount, tax = (
        F.col("l_extendedprice").cast("decimal(12,2)"),
        F.col("l_discount").cast("decimal(4,2)"),
        F.col("l_tax").cast("decimal(4,2)"),
    )
    one = F.lit(1).cast("decimal(4,2)")
    if row:
        lines = lines.withColumn(row, F.col("_metadata.row_index"))
    rows = lines.join(orders.join(customers, "o_custkey"), "l_orderkey").join(suppliers, "l_suppkey")
    return rows.select(
        F.col("l_linenumber").alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("c_nationkey").alias("pu_location_id"),
        F.col("s_nationkey").alias("do_location_id"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (price * discount).cast("decimal(12,2)").cast("double").alias("tip_amount"),
        (price * (one - discount) * (one + tax)).cast("decimal(12,2)").cast("double").alias("total_amount"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        *([row] if row else []),
    )


def raw_trips(spark: SparkSession, sf_dir: str, colour: str, row: str | None = None) -> DataFrame:
    """The trips as a raw file shows them: mixed-case names, counts as doubles, columns missing.

    The last column is the month file that the trip lies in.
    """
    mark = {"yellow": "tpep", "green": "lpep"}[colour]
    flag = F.col("store_and_fwd_flag")
    own = {
        "yellow": [F.when(flag != "N", F.lit(1.25)).alias("Airport_fee")],
        "green": [
            F.lit(None).cast("double").alias("ehail_fee"),
            F.when(flag == "A", F.lit(2.0)).when(flag == "N", F.lit(1.0)).alias("trip_type"),
        ],
    }[colour]
    return trips(spark, sf_dir, row).select(
        F.col("vendor_id").alias("VendorID"),
        F.col("pickup_datetime").alias(f"{mark}_pickup_datetime"),
        F.col("dropoff_datetime").alias(f"{mark}_dropoff_datetime"),
        F.floor(F.col("trip_distance") / 8).cast("double").alias("passenger_count"),
        "trip_distance",
        F.when(flag != "R", F.floor(F.col("trip_distance") / 10).cast("double")).alias("RatecodeID"),
        "store_and_fwd_flag",
        F.col("pu_location_id").alias("PULocationID"),
        F.col("do_location_id").alias("DOLocationID"),
        "fare_amount",
        "tip_amount",
        "total_amount",
        *own,
        month_file_column(colour, F.col("pickup_datetime")).alias("file_name"),
        *([row] if row else []),
    )
