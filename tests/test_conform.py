import hashlib
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows, yellow_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.operators.conform import cast_columns, conform, snake_case_columns
from fareloom.schemas import COLOURS, GREEN_TARGET, YELLOW_TARGET

YELLOW = COLOURS["yellow"]


def test_layout_key_and_file(spark):
    raw = yellow_rows(spark, (1, "2020-01-01 10:00:00", 7.0))
    out = conform(raw, YELLOW, F.lit("yellow_tripdata_2020-01.parquet"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in YELLOW_TARGET]
    row = out.first()
    text = "12020-01-01 10:00:002020-01-01 12:00:0010207.02.5"
    assert row.unique_id == hashlib.md5(text.encode()).hexdigest()
    assert row.file_name == "yellow_tripdata_2020-01.parquet"


def test_absent_columns_are_zero_and_present_nulls_stay(spark):
    raw = yellow_rows(spark, (1, "2020-01-01 10:00:00", None)).drop("store_and_fwd_flag").withColumns(
        {"Airport_fee": F.lit(None).cast("double"), "passenger_count": F.lit(None).cast("double")}
    )
    row = conform(raw, YELLOW, F.lit("f")).first()
    assert row.fare_amount is None and row.airport_fee is None
    assert row.passenger_count == 0
    assert row.extra == Decimal("0.00") and row.cbd_congestion_fee == Decimal("0.00")
    assert row.store_and_fwd_flag == "0"


def test_missing_key_parts_still_give_a_key(spark):
    raw = yellow_rows(spark, (None, None, None))
    row = conform(raw, YELLOW, F.lit("f")).first()
    text = "<NA>NaT2020-01-01 12:00:001020nan2.5"
    assert row.unique_id == hashlib.md5(text.encode()).hexdigest()
    assert row.vendor_id == 0 and row.tpep_pickup_datetime is None


def test_extra_columns_go_and_order_does_not_matter(spark):
    raw = yellow_rows(spark, (1, "2020-01-01 10:00:00", 7.0))
    shuffled = raw.select(*reversed(raw.columns), F.lit(1).alias("junk"))
    assert rows(conform(raw, YELLOW, F.lit("f"))) == rows(conform(shuffled, YELLOW, F.lit("f")))


def test_green_layout(spark):
    raw = (
        yellow_rows(spark, (2, "2020-01-01 10:00:00", 7.0))
        .withColumnsRenamed(
            {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
        )
        .withColumn("trip_type", F.lit(None).cast("double"))
    )
    out = conform(raw, COLOURS["green"], F.lit("f"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in GREEN_TARGET]
    assert out.first().trip_type == 0


def test_source_without_pickup_is_refused(spark):
    with pytest.raises((ValueError, KeyError)):
        conform(yellow_rows(spark, (1, "2020-01-01 10:00:00", 7.0)).drop("tpep_pickup_datetime"), YELLOW, F.lit("f"))


def test_cast_columns(spark):
    df = spark.createDataFrame([(1.0, "a", datetime(2020, 1, 1))], "RatecodeID double, flag string, t timestamp_ntz")
    out = cast_columns(df, {"RatecodeID": T.LongType()})
    assert out.dtypes == [("RatecodeID", "bigint"), ("flag", "string"), ("t", "timestamp_ntz")]
    assert snake_case_columns(out).columns == ["ratecode_id", "flag", "t"]
    with pytest.raises(Exception, match="not an integer"):
        cast_columns(df.withColumn("RatecodeID", F.lit(1.5)), {"RatecodeID": T.LongType()}).collect()
