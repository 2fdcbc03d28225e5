from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fareloom.operators.profile import footer_aggregates, footer_profile, null_profile, row_count, table_profile
from fareloom.plans import reports


@pytest.fixture(params=["10MB", "-1"])
def road(request, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", request.param)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [(1, "North"), (2, "South"), (3, None), (4, "South")], "location_id int, zone string"
    )


@pytest.fixture
def trips(spark):
    def at(day, hour=0):
        return datetime(2025, 11, day, hour)

    nan = float("nan")
    return spark.createDataFrame(
        [
            (at(1), 1, 2, 0.5, 1.0, 10.0),
            (at(18), 1, 2, 1.0, None, 20.0),
            (at(18, 23), 2, 1, 50.0, 9.0, 15.0),
            (at(18, 23), 4, 1, 150.0, 5.0, 15.0),
            (at(30, 23), 9, 1, nan, 2.0, 99.0),
            (datetime(2025, 12, 1), 1, 2, 0.1, 3.0, 10.0),
            (None, None, 2, None, 4.0, None),
        ],
        "pickup_datetime timestamp_ntz, pu_location_id int, do_location_id int, trip_distance double, "
        "tip_amount double, total_amount double",
    )


def test_short_trips(trips):
    assert rows(reports.short_trip_count(trips, "2025-11-01", "2025-12-01", 1)) == [(2,)]


def test_daily_maximum(trips):
    assert [tuple(r) for r in reports.daily_max_distance(trips, 100).collect()] == [
        (date(2025, 11, 18), 50.0),
        (date(2025, 11, 1), 0.5),
        (date(2025, 12, 1), 0.1),
    ]
    assert reports.daily_max_distance(trips, 100, limit=1).count() == 1


def test_top_zone_groups_by_name(trips, zones, road):
    """Two ids share a name; trips of an unknown zone drop out."""
    assert rows(reports.top_pickup_zone(trips, zones, "2025-11-18")) == [("South", 30.0)]
    assert rows(reports.revenue_by_zone(trips, zones)) == [("North", 40.0), ("South", 30.0)]


def test_missing_tip_counts_as_largest(trips, zones, road):
    span = ("2025-11-01", "2025-12-01")
    assert rows(reports.largest_tip_zone(trips, zones, "North", *span)) == [("South", None)]
    assert rows(reports.largest_tip_zone(trips, zones, "South", *span)) == [("North", 9.0)]
    assert rows(reports.largest_tip_zone(trips, zones, "Nowhere", *span)) == []


def test_raw_column_names(trips, zones):
    raw = trips.withColumnsRenamed({"pickup_datetime": "lpep_pickup_datetime", "pu_location_id": "PULocationID"})
    raw_zones = zones.withColumnsRenamed({"location_id": "LocationID", "zone": "Zone"})
    found = reports.top_pickup_zone(
        raw, raw_zones, "2025-11-18", pickup="lpep_pickup_datetime", pickup_zone="PULocationID",
        zone_id="LocationID", zone="Zone",
    )
    assert rows(found) == [("South", 30.0)]


def test_counts(trips):
    assert rows(row_count(trips)) == [(7,)]
    assert (2025, 11, 5) in rows(reports.rows_per_month(trips))
    assert ("green_tripdata_2025-12.parquet", 1) in rows(reports.rows_per_file_name(trips, "green"))


def test_profile_counts_nan_as_missing(trips):
    found = dict(rows(null_profile(trips)))
    assert found == {
        "pickup_datetime": 1, "pu_location_id": 1, "do_location_id": 0,
        "trip_distance": 2, "tip_amount": 1, "total_amount": 1,
    }
    first = table_profile(trips).orderBy("position").first()
    assert tuple(first) == (0, "pickup_datetime", "timestamp_ntz", 1, 7)


@pytest.mark.parametrize(
    ("report", "pushed"),
    [
        (lambda t, z: reports.short_trip_count(t, "2025-11-01", "2025-12-01", 1), "GreaterThanOrEqual(pickup_datetime"),
        (lambda t, z: reports.top_pickup_zone(t, z, "2025-11-18"), "GreaterThanOrEqual(pickup_datetime"),
        (lambda t, z: reports.daily_max_distance(t, 100), "LessThan(trip_distance"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, trips, zones, tmp_path, report, pushed):
    trips.write.parquet(str(tmp_path / "trips"))
    plan = report(spark.read.parquet(str(tmp_path / "trips")), zones)._jdf.queryExecution().executedPlan().toString()
    assert pushed in plan
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "tip_amount" not in schema and "do_location_id" not in schema


def test_footers_tell_counts_and_bounds(spark, tmp_path):
    """Aggregates are pushed into the scan: no column is read."""
    data = [(1, None, 2.0, "a", True), (None, 5, float("nan"), None, False), (7, 9, None, "b", None)]
    df = spark.createDataFrame(data, "i int, l long, d double, s string, b boolean").withColumn("day", F.date_add(F.lit("2019-12-31").cast("date"), F.col("i")))
    whole = df.withColumn("n", F.lit(4)).select("n", F.coalesce("l", F.lit(1)).alias("m"), "d", "s")
    whole.repartition(3).write.parquet(str(tmp_path / "whole"))
    plan = footer_aggregates(spark, str(tmp_path / "whole"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(n), MIN(n), MAX(n), COUNT(m)" in plan and "PushedGroupBy: []" in plan
    # What the scan hands on are the aggregates themselves.
    assert "ReadSchema: struct<count(*):bigint,count(n):bigint,min(n):int,max(n):int" in plan
    assert rows(footer_profile(spark, str(tmp_path / "whole"))) == sorted([("n", 3, 4, 4, 3), ("m", 3, 1, 9, 3), ("d", 2, None, None, 3), ("s", 2, None, None, 3)], key=repr)
    # A file with nothing but NULL in a column has no bounds in its footer.
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    assert rows(footer_profile(spark, str(tmp_path / "t"))) == sorted(
        [("i", 2, 1, 7, 3), ("l", 2, 5, 9, 3), ("d", 2, None, None, 3), ("s", 2, None, None, 3), ("day", 2, 18262, 18268, 3), ("b", 2, 0, 1, 3)], key=repr
    )
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1
