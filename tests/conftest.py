import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fareloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "fareloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    """The smallest check tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture
def setting(spark):
    """Set session settings for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def no_broadcast(setting):
    """The road that large right sides take."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


YELLOW_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double"
)


def yellow_rows(spark, *trips):
    """Raw yellow rows from (vendor, pickup text, fare) triples; the rest is the same in all."""
    from datetime import datetime

    data = [
        (
            vendor,
            pickup and datetime.fromisoformat(pickup),
            datetime(2020, 1, 1, 12),
            1.0,
            2.5,
            1.0,
            "N",
            10,
            20,
            1,
            fare,
        )
        for vendor, pickup, fare in trips
    ]
    return spark.createDataFrame(data, YELLOW_SCHEMA)
