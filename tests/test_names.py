import pytest
from pyspark.sql import functions as F

from fareloom.functions import names


@pytest.mark.parametrize(
    ("raw", "snake"),
    [
        ("VendorID", "vendor_id"),
        ("PULocationID", "pu_location_id"),
        ("DOLocationID", "do_location_id"),
        ("RatecodeID", "ratecode_id"),
        ("Airport_fee", "airport_fee"),
        ("LocationID", "location_id"),
        ("tpep_pickup_datetime", "tpep_pickup_datetime"),
        ("Airport_Fee", "airport__fee"),
        ("Trip Type", "trip _type"),
        ("_Id", "__id"),
        ("ID", "id"),
        ("Zone2Name", "zone2_name"),
        ("x2Y", "x2_y"),
        ("aBC", "a_bc"),
        ("ABc", "a_bc"),
        ("feeTaxABCd", "fee_tax_ab_cd"),
        ("ÉtatNom", "état_nom"),
        ("", ""),
    ],
)
def test_snake_case(raw, snake):
    assert names.snake_case(raw) == snake


def test_month_file_names(spark):
    assert names.month_file_name("green", 2020, 4, "csv") == "green_tripdata_2020-04.csv"
    row = spark.sql("SELECT TIMESTAMP_NTZ'2020-04-30 23:59:59' t")
    assert row.select(names.month_file_column("green", F.col("t"))).first()[0] == "green_tripdata_2020-04.parquet"


@pytest.mark.parametrize(
    ("path", "name"),
    [
        ("s3://b/trips/yellow_tripdata_2020-12.csv.gz", "yellow_tripdata_2020-12.csv.gz"),
        ("/d/file_name=yellow_tripdata_2020-01.parquet/part-0.snappy.parquet", "yellow_tripdata_2020-01.parquet"),
        ("/d/yellow_tripdata_2020-01.parquet/part-0.c000.parquet", "yellow_tripdata_2020-01.parquet"),
        ("/d/zones.csv", ""),
    ],
)
def test_month_file_of_a_path(spark, path, name):
    assert spark.range(1).select(names.month_file_of(F.lit(path))).first()[0] == name


def test_month_of_file(spark):
    names_ = spark.createDataFrame([("green_tripdata_2020-04.csv.gz",), ("zones.csv",)], "n string")
    assert [r[0] for r in names_.select(names.month_of_file(F.col("n"))).collect()] == ["2020-04", ""]


def test_months_between():
    assert list(names.months_between((2020, 11), (2021, 2))) == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]
    assert list(names.months_between((2021, 1), (2020, 12))) == []
