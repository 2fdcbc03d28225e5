"""The registered queries again as plain SQL over the check tables, written independently."""

from __future__ import annotations

TRIPS = """trips AS (
  SELECT l_linenumber AS vendor_id,
         o_orderdate AS pickup_datetime,
         l_shipdate AS dropoff_datetime,
         c_nationkey AS pu_location_id,
         s_nationkey AS do_location_id,
         l_quantity AS trip_distance,
         l_extendedprice AS fare_amount,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
              AS DECIMAL(12,2)) AS DOUBLE) AS tip_amount,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              * (CAST(1 AS DECIMAL(4,2)) + CAST(l_tax AS DECIMAL(4,2)))
              AS DECIMAL(12,2)) AS DOUBLE) AS total_amount,
         l_returnflag AS store_and_fwd_flag
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

ZONES = """zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

UNIQUE_ID = """md5(concat(
    CAST(vendor_id AS VARCHAR), strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
    strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), CAST(pu_location_id AS VARCHAR),
    CAST(do_location_id AS VARCHAR), CAST(fare_amount AS VARCHAR), CAST(trip_distance AS VARCHAR)))"""

PASSENGERS = "CAST(floor(trip_distance / 8) AS INTEGER)"
RATECODE = "CASE WHEN store_and_fwd_flag <> 'R' THEN CAST(floor(trip_distance / 10) AS INTEGER) ELSE 0 END"


def _money(expression: str, name: str) -> str:
    return f"CAST({expression} AS DECIMAL(10,2)) AS {name}"


def _conformed(colour: str, where: str = "", file_name: str | None = None, change: str = "") -> str:
    """``change`` is a further step that puts another ``trips`` in place of the plain ones."""
    file_name = file_name or f"'{colour}_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet'"
    mark = {"yellow": "tpep", "green": "lpep"}[colour]
    head = f"""{UNIQUE_ID} AS unique_id,
       {file_name} AS file_name,
       vendor_id,
       pickup_datetime AS {mark}_pickup_datetime,
       dropoff_datetime AS {mark}_dropoff_datetime"""
    ids = "CAST(pu_location_id AS INTEGER) AS pu_location_id, CAST(do_location_id AS INTEGER) AS do_location_id"
    if colour == "yellow":
        body = f"""{PASSENGERS} AS passenger_count, {_money('trip_distance', 'trip_distance')},
       {RATECODE} AS ratecode_id, store_and_fwd_flag, {ids}, 0 AS payment_type,
       {_money('fare_amount', 'fare_amount')}, {_money('0', 'extra')}, {_money('0', 'mta_tax')},
       {_money('tip_amount', 'tip_amount')}, {_money('0', 'tolls_amount')},
       {_money('0', 'improvement_surcharge')}, {_money('total_amount', 'total_amount')},
       {_money('0', 'congestion_surcharge')},
       {_money("CASE WHEN store_and_fwd_flag <> 'N' THEN 1.25 END", 'airport_fee')},
       {_money('0', 'cbd_congestion_fee')}"""
    else:
        body = f"""store_and_fwd_flag, {RATECODE} AS ratecode_id, {ids},
       {PASSENGERS} AS passenger_count, {_money('trip_distance', 'trip_distance')},
       {_money('fare_amount', 'fare_amount')}, {_money('0', 'extra')}, {_money('0', 'mta_tax')},
       {_money('tip_amount', 'tip_amount')}, {_money('0', 'tolls_amount')}, {_money('NULL', 'ehail_fee')},
       {_money('0', 'improvement_surcharge')}, {_money('total_amount', 'total_amount')}, 0 AS payment_type,
       CASE store_and_fwd_flag WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END AS trip_type,
       {_money('0', 'congestion_surcharge')}, {_money('0', 'cbd_congestion_fee')}"""
    source = "changed" if change else "trips"
    steps = f"{TRIPS}, changed AS ({change})" if change else TRIPS
    return f"WITH {steps}\nSELECT {head},\n       {body}\nFROM {source}{where}"


LINE_COLUMNS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

RAW_YELLOW_COLUMNS = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "floor(trip_distance / 8)",
    "trip_distance": "trip_distance",
    "RatecodeID": "CASE WHEN store_and_fwd_flag <> 'R' THEN floor(trip_distance / 10) END",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
    "Airport_fee": "CASE WHEN store_and_fwd_flag <> 'N' THEN 1.25 END",
    "file_name": "strftime(pickup_datetime, '%Y-%m')",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_MERGE = """target AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
source AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01'),
added AS (
  SELECT s.* FROM source s
  WHERE NOT EXISTS (
    SELECT 1 FROM target t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
)"""

_TOP_ZONE = f"""WITH {TRIPS}, {ZONES}
SELECT zone, CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DOUBLE) AS total_sum
FROM trips JOIN zones ON pu_location_id = location_id
WHERE CAST(pickup_datetime AS DATE) = DATE '1995-11-18'
GROUP BY zone ORDER BY total_sum DESC NULLS FIRST, zone LIMIT 1"""

_SHORT_TRIPS = f"""WITH {TRIPS}
SELECT count(1) AS n FROM trips
WHERE pickup_datetime >= TIMESTAMP '1995-11-01' AND pickup_datetime < TIMESTAMP '1995-12-01'
  AND trip_distance <= 10"""

_DAILY_MAX = f"""WITH {TRIPS}
SELECT CAST(pickup_datetime AS DATE) AS pickup_day, max(trip_distance) AS max_distance
FROM trips WHERE trip_distance < 50 GROUP BY 1
ORDER BY max_distance DESC NULLS FIRST, pickup_day LIMIT 1000"""

_LARGEST_TIP = f"""WITH {TRIPS}, {ZONES}
SELECT zdo.zone AS dropoff_zone, tip_amount
FROM trips
JOIN zones zpu ON pu_location_id = zpu.location_id
JOIN zones zdo ON do_location_id = zdo.location_id
WHERE zpu.zone = 'NATION_0'
  AND pickup_datetime >= TIMESTAMP '1995-11-01' AND pickup_datetime < TIMESTAMP '1995-12-01'
ORDER BY tip_amount DESC NULLS FIRST, dropoff_zone LIMIT 1"""

_PER_FILE = f"""WITH {TRIPS}
SELECT 'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS file_name, count(*) AS n
FROM trips GROUP BY 1"""

_WRONG_FILES = """SELECT *, 'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS in_file FROM trips
UNION ALL SELECT trips.*, 'yellow_tripdata_1995-02.parquet' FROM trips, range(2) WHERE pu_location_id < 5
UNION ALL SELECT *, 'yellow_tripdata_2001-01.parquet' FROM trips WHERE pu_location_id BETWEEN 5 AND 9"""

ORACLES: dict[str, str] = {
    "count_trips": f"WITH {TRIPS} SELECT count(*) AS n FROM trips",
    "scan_zones": f"WITH {ZONES} SELECT * FROM zones",
    "short_trip_count": _SHORT_TRIPS,
    "daily_max_distance": _DAILY_MAX,
    "top_pickup_zone": _TOP_ZONE,
    "revenue_by_zone": f"""WITH {TRIPS}, {ZONES}
SELECT zone, CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DOUBLE) AS total_sum
FROM trips JOIN zones ON pu_location_id = location_id GROUP BY zone""",
    "largest_tip_zone": _LARGEST_TIP,
    "rows_per_month": f"""WITH {TRIPS}
SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       count(*) AS n
FROM trips GROUP BY 1, 2""",
    "rows_per_file_name": _PER_FILE,
    "rows_per_month_file": _PER_FILE,
    "rows_per_csv_file": f"""WITH {TRIPS}
SELECT 'green_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.csv.gz' AS file_name, count(*) AS n
FROM trips GROUP BY 1""",
    "rows_in_year": f"WITH {TRIPS} SELECT count(*) AS n FROM trips WHERE year(pickup_datetime) = 1996",
    "loaded_tables_sql": _TOP_ZONE,
    "loaded_short_trips_sql": _SHORT_TRIPS,
    "loaded_daily_max_sql": _DAILY_MAX,
    "loaded_largest_tip_sql": _LARGEST_TIP,
    "trip_unique_id": f"WITH {TRIPS} SELECT {UNIQUE_ID} AS unique_id FROM trips",
    "money_decimal": """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount
FROM lineitem""",
    "coerce_ints": """SELECT event_id,
       CAST(coalesce(trunc(try_cast(event_type AS DOUBLE)), 0) AS INTEGER) AS event_type_int,
       CAST(coalesce(trunc(try_cast(json_extract_string(props, '$.k') AS DOUBLE)), 0) AS INTEGER) AS k_int,
       CAST(coalesce(trunc(value), 0) AS INTEGER) AS value_int,
       CAST(coalesce(user_id, 0) AS INTEGER) AS user_id_int
FROM events""",
    "strict_casts": f"""WITH {TRIPS}
SELECT fare_amount, CAST(vendor_id AS BIGINT) AS "VendorID",
       CASE WHEN store_and_fwd_flag <> 'R' THEN CAST(floor(trip_distance / 10) AS BIGINT) END AS "RatecodeID",
       CAST(floor(trip_distance / 8) AS BIGINT) AS passenger_count,
       CASE store_and_fwd_flag WHEN 'A' THEN CAST(2 AS BIGINT) WHEN 'N' THEN 1 END AS trip_type,
       store_and_fwd_flag
FROM trips""",
    "conform_trips": _conformed("yellow"),
    "conform_green_trips": _conformed("green"),
    "null_profile": _union(
        [f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count FROM lineitem" for name in LINE_COLUMNS]
    ),
    "null_profile_trips": f"WITH {TRIPS}\n"
    + _union(
        [
            f"SELECT '{name}' AS column_name, count(*) - count({value}) AS null_count FROM trips"
            for name, value in RAW_YELLOW_COLUMNS.items()
        ]
    ),
    "footer_profile": _union(
        [
            f"""SELECT '{name}' AS column_name, count({name}) AS value_count,
       {f"CAST(min({name}) AS BIGINT)" if kind in ("bigint", "int") else "CAST(NULL AS BIGINT)"} AS least,
       {f"CAST(max({name}) AS BIGINT)" if kind in ("bigint", "int") else "CAST(NULL AS BIGINT)"} AS largest,
       count(*) AS row_count FROM lineitem"""
            for name, kind in LINE_COLUMNS.items()
        ]
    ),
    "profile_table": _union(
        [
            f"SELECT {place} AS position, '{name}' AS column_name, '{kind}' AS data_type, "
            f"count(*) - count({name}) AS null_count, count(*) AS row_count FROM lineitem"
            for place, (name, kind) in enumerate(LINE_COLUMNS.items())
        ]
    ),
    "sorted_by_dropoff": f"""WITH {TRIPS}, raw AS (
  SELECT {UNIQUE_ID} AS unique_id, vendor_id AS "VendorID", pickup_datetime AS tpep_pickup_datetime,
         dropoff_datetime AS tpep_dropoff_datetime, CAST(floor(trip_distance / 8) AS DOUBLE) AS passenger_count,
         trip_distance,
         CASE WHEN store_and_fwd_flag <> 'R' THEN CAST(floor(trip_distance / 10) AS DOUBLE) END AS "RatecodeID",
         store_and_fwd_flag, pu_location_id AS "PULocationID", do_location_id AS "DOLocationID", fare_amount,
         tip_amount, total_amount, CASE WHEN store_and_fwd_flag <> 'N' THEN CAST(1.25 AS DOUBLE) END AS "Airport_fee",
         'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS file_name
  FROM trips
)
SELECT row_number() OVER (ORDER BY tpep_dropoff_datetime NULLS LAST, unique_id, tip_amount, total_amount,
                                   store_and_fwd_flag) - 1 AS place, raw.*
FROM raw""",
    "preview_trips": f"""WITH {TRIPS}
SELECT * FROM trips
ORDER BY dropoff_datetime NULLS LAST, fare_amount NULLS LAST, total_amount NULLS LAST, vendor_id NULLS LAST
LIMIT 100""",
    "row_index": 'SELECT row_number() OVER () - 1 AS "index", * FROM lineitem',
    "csv_row_index": """SELECT row_number() OVER (ORDER BY CASE WHEN o_orderkey % 10 < 3 THEN 0 WHEN o_orderkey % 10 = 3 THEN 1
                                 ELSE 2 END, o_orderkey) - 1 AS "index", *
FROM orders""",
    "stream_row_index": 'SELECT row_number() OVER (ORDER BY o_orderkey % 6, o_orderkey) - 1 AS "index", * FROM orders',
    "csv_gz_round_trip": "SELECT * FROM lineitem",
    "inferred_csv_scan": """SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
                  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority)
FROM orders""",
    "tsv_round_trip": "SELECT * FROM lineitem",
    "tsv_staged_trips": _conformed("green"),
    "parquet_round_trip": "SELECT * FROM orders",
    "replace_then_append": "SELECT * FROM lineitem",
    "truncate_then_load": "SELECT * FROM lineitem",
    "union_of_parts": """SELECT * REPLACE (CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN l_tax END AS l_tax)
FROM lineitem""",
    "uncompressed_bytes": """WITH sizes AS (
  SELECT 'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS file_name,
         CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + strlen(CAST(o_custkey AS VARCHAR))
             + strlen(o_orderstatus) + strlen(CAST(o_totalprice AS VARCHAR)) + strlen(o_orderpriority)
             + length('1995-01-01 00:00:00.000000') + 6) AS BIGINT) AS bytes
  FROM orders GROUP BY 1
)
SELECT file_name, bytes, round(bytes / 1048576.0, 1) AS mib FROM sizes""",
    "csv_month_replaced": f"""WITH {TRIPS}
SELECT CAST(vendor_id AS BIGINT) AS "VendorID", pickup_datetime AS tpep_pickup_datetime,
       dropoff_datetime AS tpep_dropoff_datetime, CAST(floor(trip_distance / 8) AS BIGINT) AS passenger_count,
       trip_distance,
       CASE WHEN store_and_fwd_flag <> 'R' THEN CAST(floor(trip_distance / 10) AS BIGINT) END AS "RatecodeID",
       store_and_fwd_flag, CAST(pu_location_id AS BIGINT) AS "PULocationID",
       CAST(do_location_id AS BIGINT) AS "DOLocationID", fare_amount, tip_amount, total_amount,
       CASE WHEN store_and_fwd_flag <> 'N' THEN '1.25' END AS "Airport_fee"
FROM trips""",
    "merge_insert_only": f"WITH {_MERGE} SELECT * FROM target UNION ALL SELECT * FROM added",
    "merge_inserted_count": f"WITH {_MERGE} SELECT count(*) AS n FROM added",
    "first_month_wins": """WITH months AS (
  SELECT *, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem
), firsts AS (
  SELECT l_orderkey, l_linenumber, min(ship_month) AS first_month FROM months GROUP BY 1, 2
)
SELECT months.* FROM months JOIN firsts
  ON months.l_orderkey = firsts.l_orderkey AND months.l_linenumber = firsts.l_linenumber
 AND ship_month = first_month""",
    "load_one_month": _conformed(
        "green",
        "\nWHERE pickup_datetime >= TIMESTAMP '1995-11-01' AND pickup_datetime < TIMESTAMP '1995-12-01'",
    ),
    "backfill_year": _conformed(
        "yellow",
        "\nWHERE pickup_datetime >= TIMESTAMP '1995-01-01' AND pickup_datetime < TIMESTAMP '1996-01-01'",
    ),
    "backfill_all_months": _conformed("yellow"),
    "backfill_one_per_key": _conformed("yellow"),
    "load_history": f"""WITH {TRIPS}
SELECT 'yellow_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS label, count(*) AS offered, count(*) AS inserted
FROM trips WHERE year(pickup_datetime) = 1995 GROUP BY 1
UNION ALL
SELECT 'yellow_tripdata_1995-01.parquet to yellow_tripdata_2001-12.parquet', count(*),
       count(*) FILTER (year(pickup_datetime) <> 1995)
FROM trips""",
    "load_metrics": f"WITH {TRIPS} SELECT count(*) AS offered, count(*) AS first_run, CAST(0 AS BIGINT) AS second_run FROM trips",
    "backfill_stray_dates": _conformed(
        "yellow",
        file_name="'yellow_tripdata_1995-01.parquet'",
        change="""SELECT * REPLACE (pickup_datetime + to_years(CAST(pu_location_id * 25 + do_location_id AS INTEGER))
                          AS pickup_datetime) FROM trips""",
    ),
    # Month by month: a key that an earlier file has brought is not taken again.
    "backfill_wrong_files": f"""SELECT * FROM (
  {_conformed("yellow", file_name="in_file", change=_WRONG_FILES)}
) QUALIFY file_name = min(file_name) OVER (PARTITION BY unique_id)""",
    "stream_ingest": _conformed("yellow"),
    "stream_ingest_csv": _conformed(
        "yellow",
        file_name="'yellow_tripdata_1995-' || lpad(CAST(3 * quarter(pickup_datetime) AS VARCHAR), 2, '0') || '.csv.gz'",
    ),
}
