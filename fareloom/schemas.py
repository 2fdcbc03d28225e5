"""Column layouts of raw files, conformed rows and target tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# Spellings that a raw CSV file uses for a missing value (fixed values).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_LONG, _DOUBLE, _TEXT, _TIME, _INT = (
    T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType(), T.IntegerType(),
)


# Column names and their order (fixed values).
RAW_YELLOW = T.StructType(
    [
        T.StructField("VendorID", _LONG),
        T.StructField("tpep_pickup_datetime", _TIME),
        T.StructField("tpep_dropoff_datetime", _TIME),
        T.StructField("passenger_count", _LONG),
        T.StructField("trip_distance", _DOUBLE),
        T.StructField("RatecodeID", _LONG),
        T.StructField("store_and_fwd_flag", _TEXT),
        T.StructField("PULocationID", _LONG),
        T.StructField("DOLocationID", _LONG),
        T.StructField("payment_type", _LONG),
        T.StructField("fare_amount", _DOUBLE),
        T.StructField("extra", _DOUBLE),
        T.StructField("mta_tax", _DOUBLE),
        T.StructField("tip_amount", _DOUBLE),
        T.StructField("tolls_amount", _DOUBLE),
        T.StructField("improvement_surcharge", _DOUBLE),
        T.StructField("total_amount", _DOUBLE),
        T.StructField("congestion_surcharge", _DOUBLE),
    ]
)

# Green files carry their own types; these columns are cast after the scan.
RAW_GREEN_CASTS = {
    "VendorID": _LONG,
    "RatecodeID": _LONG,
    "passenger_count": _LONG,
    "payment_type": _LONG,
    "trip_type": _LONG,
    "store_and_fwd_flag": _TEXT,
}

# Column names and their order (fixed values).
ZONE_LOOKUP = T.StructType(
    [
        T.StructField("LocationID", _LONG),
        T.StructField("Borough", _TEXT),
        T.StructField("Zone", _TEXT),
        T.StructField("service_zone", _TEXT),
    ]
)

# Column names and their order (fixed values).
YELLOW_TARGET = T.StructType(
    [
        T.StructField("unique_id", _TEXT),
        T.StructField("file_name", _TEXT),
        T.StructField("vendor_id", _INT),
        T.StructField("tpep_pickup_datetime", _TIME),
        T.StructField("tpep_dropoff_datetime", _TIME),
        T.StructField("passenger_count", _INT),
        T.StructField("trip_distance", MONEY),
        T.StructField("ratecode_id", _INT),
        T.StructField("store_and_fwd_flag", _TEXT),
        T.StructField("pu_location_id", _INT),
        T.StructField("do_location_id", _INT),
        T.StructField("payment_type", _INT),
        T.StructField("fare_amount", MONEY),
        T.StructField("extra", MONEY),
        T.StructField("mta_tax", MONEY),
        T.StructField("tip_amount", MONEY),
        T.StructField("tolls_amount", MONEY),
        T.StructField("improvement_surcharge", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("congestion_surcharge", MONEY),
        T.StructField("airport_fee", MONEY),
        T.StructField("cbd_congestion_fee", MONEY),
    ]
)

# Column names and their order (fixed values).
GREEN_TARGET = T.StructType(
    [
        T.StructField("unique_id", _TEXT),
        T.StructField("file_name", _TEXT),
        T.StructField("vendor_id", _INT),
        T.StructField("lpep_pickup_datetime", _TIME),
        T.StructField("lpep_dropoff_datetime", _TIME),
        T.StructField("store_and_fwd_flag", _TEXT),
        T.StructField("ratecode_id", _INT),
        T.StructField("pu_location_id", _INT),
        T.StructField("do_location_id", _INT),
        T.StructField("passenger_count", _INT),
        T.StructField("trip_distance", MONEY),
        T.StructField("fare_amount", MONEY),
        T.StructField("extra", MONEY),
        T.StructField("mta_tax", MONEY),
        T.StructField("tip_amount", MONEY),
        T.StructField("tolls_amount", MONEY),
        T.StructField("ehail_fee", MONEY),
        T.StructField("improvement_surcharge", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("payment_type", _INT),
        T.StructField("trip_type", _INT),
        T.StructField("congestion_surcharge", MONEY),
        T.StructField("cbd_congestion_fee", MONEY),
    ]
)

KEY = "unique_id"
FILE_NAME = "file_name"
PICKUP_MONTH = "pickup_month"


@dataclass(frozen=True)
class Colour:
    """What sets one fleet's files apart from the other's."""

    name: str
    pickup: str
    dropoff: str
    target: T.StructType

    @property
    def key_parts(self) -> list[str]:
        """Raw columns whose texts make up the row key, in order."""
        return [
            "VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID", "fare_amount", "trip_distance",
        ]


COLOURS = {
    "yellow": Colour("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", YELLOW_TARGET),
    "green": Colour("green", "lpep_pickup_datetime", "lpep_dropoff_datetime", GREEN_TARGET),
}
