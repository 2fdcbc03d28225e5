"""Questions asked of trips and zones.

Column names default to the conformed ones; raw tables pass their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.names import month_file_column, months_between
from fareloom.functions.values import to_money
from fareloom.operators.ordering import top_n
from fareloom.operators.profile import rows_per_file
from fareloom.sources.files import present_months, scan_csv


def _between(moment: str, start: str, end: str) -> Column:
    """Half-open range; the scan gets both bounds."""
    return (F.col(moment) >= F.lit(start).cast("timestamp_ntz")) & (F.col(moment) < F.lit(end).cast("timestamp_ntz"))


def short_trip_count(
    trips: DataFrame,
    start: str,
    end: str,
    at_most: float,
    pickup: str = "pickup_datetime",
    distance: str = "trip_distance",
) -> DataFrame:
    kept = trips.where(_between(pickup, start, end) & (F.col(distance) <= at_most))
    return kept.agg(F.count(F.lit(1)).alias("n"))


def daily_max_distance(
    trips: DataFrame,
    below: float,
    limit: int = 1000,
    pickup: str = "pickup_datetime",
    distance: str = "trip_distance",
) -> DataFrame:
    """The longest trip of each day among those below a cut-off, longest days first."""
    days = (
        trips.where(F.col(distance) < below)
        .groupBy(F.col(pickup).cast("date").alias("pickup_day"))
        .agg(F.max(distance).alias("max_distance"))
    )
    return top_n(days, "max_distance", limit, "pickup_day")


def revenue_by_zone(
    trips: DataFrame,
    zones: DataFrame,
    day: str | None = None,
    pickup: str = "pickup_datetime",
    pickup_zone: str = "pu_location_id",
    total: str = "total_amount",
    zone_id: str = "location_id",
    zone: str = "zone",
) -> DataFrame:
    """Exact total per pickup zone name, of one day or of all.

    Trips are summed by zone id first: the join then meets one row per zone id, however
    the trips are spread over the zones, and needs no care for hot ids.
    """
    kept = trips if day is None else trips.where(F.col(pickup).cast("date") == F.lit(day).cast("date"))
    by_id = kept.groupBy(F.col(pickup_zone).alias("_zone_id")).agg(F.sum(to_money(F.col(total))).alias("_total"))
    names = zones.select(F.col(zone_id).alias("_zone_id"), F.col(zone).alias("zone"))
    return by_id.join(names, "_zone_id").groupBy("zone").agg(F.sum("_total").cast("double").alias("total_sum"))


def top_pickup_zone(trips: DataFrame, zones: DataFrame, day: str, **columns: str) -> DataFrame:
    return top_n(revenue_by_zone(trips, zones, day, **columns), "total_sum", 1, "zone")


def largest_tip_zone(
    trips: DataFrame,
    zones: DataFrame,
    from_zone: str,
    start: str,
    end: str,
    pickup: str = "pickup_datetime",
    pickup_zone: str = "pu_location_id",
    dropoff_zone: str = "do_location_id",
    tip: str = "tip_amount",
    zone_id: str = "location_id",
    zone: str = "zone",
) -> DataFrame:
    """Dropoff zone of the largest tip among trips from one zone; the zone table plays both roles."""
    kept = trips.where(_between(pickup, start, end)).select(
        F.col(pickup_zone).alias("_from_id"), F.col(dropoff_zone).alias("_to_id"), F.col(tip).alias("tip_amount")
    )
    origin = zones.where(F.col(zone) == from_zone).select(F.col(zone_id).alias("_from_id"))
    target = zones.select(F.col(zone_id).alias("_to_id"), F.col(zone).alias("dropoff_zone"))
    pairs = kept.join(origin, "_from_id").join(target, "_to_id")
    return top_n(pairs.select("dropoff_zone", "tip_amount"), "tip_amount", 1, "dropoff_zone")


def rows_per_month(trips: DataFrame, pickup: str = "pickup_datetime") -> DataFrame:
    moment = F.col(pickup)
    return trips.groupBy(F.year(moment).alias("year"), F.month(moment).alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


def rows_per_file_name(trips: DataFrame, colour: str, pickup: str = "pickup_datetime") -> DataFrame:
    """Trips per month file they belong to by their pickup time."""
    return trips.groupBy(month_file_column(colour, F.col(pickup)).alias("file_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


def rows_per_csv_file(
    spark: SparkSession, prefix: str, colour: str, first: tuple[int, int], last: tuple[int, int], extension: str = "csv.gz"
) -> DataFrame:
    """Row count of every CSV month file in a span, in one scan; absent months have no row."""
    paths = present_months(spark, prefix, colour, months_between(first, last), extension)
    return rows_per_file(scan_csv(spark, *paths, same_header=False))


def rows_in_year(spark: SparkSession, prefix: str, colour: str, year: int, extension: str = "csv.gz") -> DataFrame:
    """Row total over the month files of a year."""
    return rows_per_csv_file(spark, prefix, colour, (year, 1), (year, 12), extension).agg(F.sum("n").alias("n"))
