"""Every operator as a runnable query over the check tables.

Each function takes the session and a table folder. Those that write use the shared
scratch folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.names import month_file_column
from fareloom.functions.values import coerce_int, to_money
from fareloom.operators import merge, profile
from fareloom.operators.conform import cast_columns, conform, trip_key
from fareloom.operators.ordering import number_file_rows, number_sorted_rows, preview
from fareloom.plans import loads, reports
from fareloom.plans.views import raw_trips, table, trips, zones
from fareloom.schemas import COLOURS, FILE_NAME, RAW_GREEN_CASTS
from fareloom.session import remove_path, scratch_path, shuffles_freed
from fareloom.sinks import publish
from fareloom.sinks.files import gathered, read_tsv, write_csv_gz, write_parquet, write_tsv
from fareloom.sinks.publish import committed_paths
from fareloom.sinks.tables import append_table, create_table, replace_empty, replace_table, truncate_table
from fareloom.sources.files import read_csv, read_inferred_csv, read_parquet, union_all
from fareloom.sources.sizes import expanded_sizes
from fareloom.streaming.ingest import append_stream, ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
LINE_KEY = ["l_orderkey", "l_linenumber"]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


class _Table:
    """A catalog table of its own name and place, for one query run."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.name = f"{label}_{uuid.uuid4().hex}"
        self.location = scratch_path(spark, label)

    def rows(self, columns: list[str] | None = None) -> DataFrame:
        """The stored rows; the catalog entry goes, the files stay."""
        columns = columns or self.spark.table(self.name).columns
        schema = self.spark.table(self.name).select(*columns).schema
        self.spark.sql(f"DROP TABLE {self.name}")
        paths = committed_paths(self.spark, self.location)
        # Without partition columns, which the files don't hold.
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", True)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)


def _month_files(spark: SparkSession, sf_dir: str, colour: str = "yellow") -> str:
    """Raw trips written as one folder per month; returns the prefix before the month file names."""
    root = scratch_path(spark, "months")
    write_parquet(raw_trips(spark, sf_dir, colour), root, [FILE_NAME])
    return f"{root}/{FILE_NAME}="


# Reports


@query
def count_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(trips(spark, sf_dir))


@query
def scan_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones(spark, sf_dir)


@query
def short_trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.short_trip_count(trips(spark, sf_dir), "1995-11-01", "1995-12-01", 10)


@query
def daily_max_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_max_distance(trips(spark, sf_dir), below=50, limit=1000)


@query
def top_pickup_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_pickup_zone(trips(spark, sf_dir), zones(spark, sf_dir), "1995-11-18")


@query
def revenue_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_zone(trips(spark, sf_dir), zones(spark, sf_dir))


@query
def largest_tip_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.largest_tip_zone(
        trips(spark, sf_dir), zones(spark, sf_dir), "NATION_0", "1995-11-01", "1995-12-01"
    )


@query
def rows_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rows_per_month(trips(spark, sf_dir))


@query
def rows_per_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rows_per_file_name(trips(spark, sf_dir), "yellow")


@query
def rows_per_month_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts attributed to the file each row was read from."""
    prefix = _month_files(spark, sf_dir)
    return profile.rows_per_file(spark.read.parquet(prefix + "*"))


@query
def rows_per_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over gzip CSV files, for a span whose last months have no file."""
    root = scratch_path(spark, "months")
    raw = raw_trips(spark, sf_dir, "green")
    name = F.replace(FILE_NAME, F.lit(".parquet"), F.lit(".csv.gz"))
    write_csv_gz(raw.withColumn(FILE_NAME, name), root, partition_by=[FILE_NAME])
    return reports.rows_per_csv_file(spark, f"{root}/{FILE_NAME}=", "green", (1995, 1), (2001, 12))


@query
def rows_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One total over the gzip CSV files of a year."""
    root = scratch_path(spark, "months")
    name = F.replace(FILE_NAME, F.lit(".parquet"), F.lit(".csv.gz"))
    write_csv_gz(raw_trips(spark, sf_dir, "yellow").withColumn(FILE_NAME, name), root, partition_by=[FILE_NAME])
    return reports.rows_in_year(spark, f"{root}/{FILE_NAME}=", "yellow", 1996)


def _asked_of_tables(spark: SparkSession, sf_dir: str, question: str) -> DataFrame:
    """Raw green files and a zone CSV loaded as tables, then asked in SQL text."""
    root = scratch_path(spark, "reports")
    write_parquet(raw_trips(spark, sf_dir, "green").drop(FILE_NAME), f"{root}/raw")
    lookup = zones(spark, sf_dir).select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone")
    )
    write_csv_gz(lookup, f"{root}/zones")
    trips_table, zones_table = (f"{label}_{uuid.uuid4().hex}" for label in ("green_trips", "zone_lookup"))
    loads.load_for_reports(spark, [f"{root}/raw"], [f"{root}/zones"], trips_table, zones_table, f"{root}/tables")
    found = spark.sql(question.format(trips=trips_table, zones=zones_table))
    for name in (trips_table, zones_table):
        spark.sql(f"DROP TABLE {name}")
    return found


@query
def loaded_tables_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked_of_tables(
        spark,
        sf_dir,
        """
        SELECT z.Zone AS zone, CAST(SUM(CAST(t.total_amount AS DECIMAL(10, 2))) AS DOUBLE) AS total_sum
        FROM {trips} t
        JOIN {zones} z ON t.PULocationID = z.LocationID
        WHERE CAST(t.lpep_pickup_datetime AS DATE) = '1995-11-18'
        GROUP BY z.Zone
        ORDER BY total_sum DESC NULLS FIRST, zone
        LIMIT 1
        """,
    )


@query
def loaded_short_trips_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked_of_tables(
        spark,
        sf_dir,
        """
        SELECT COUNT(1) AS n
        FROM {trips}
        WHERE lpep_pickup_datetime >= '1995-11-01' AND lpep_pickup_datetime < '1995-12-01' AND trip_distance <= 10
        """,
    )


@query
def loaded_daily_max_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked_of_tables(
        spark,
        sf_dir,
        """
        SELECT CAST(lpep_pickup_datetime AS DATE) AS pickup_day, MAX(trip_distance) AS max_distance
        FROM {trips}
        WHERE trip_distance < 50
        GROUP BY pickup_day
        ORDER BY max_distance DESC NULLS FIRST, pickup_day
        LIMIT 1000
        """,
    )


@query
def loaded_largest_tip_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked_of_tables(
        spark,
        sf_dir,
        """
        SELECT zone_to.Zone AS dropoff_zone, t.tip_amount
        FROM {trips} t
        JOIN {zones} zone_from ON t.PULocationID = zone_from.LocationID
        JOIN {zones} zone_to ON t.DOLocationID = zone_to.LocationID
        WHERE zone_from.Zone = 'NATION_0'
          AND t.lpep_pickup_datetime >= '1995-11-01' AND t.lpep_pickup_datetime < '1995-12-01'
        ORDER BY t.tip_amount DESC NULLS FIRST, dropoff_zone
        LIMIT 1
        """,
    )


# Columns


@query
def trip_unique_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir, "yellow")
    return raw.select(trip_key(raw, COLOURS["yellow"]).alias("unique_id"))


@query
def money_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*LINE_KEY, to_money(F.col("l_extendedprice")).alias("amount"))


@query
def coerce_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    kinds = {field.name: field.dataType for field in events.schema.fields}
    return events.select(
        "event_id",
        *[coerce_int(F.col(name), kinds[name]).alias(f"{name}_int") for name in ("event_type", "k", "value", "user_id")],
    )


@query
def strict_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_trips(spark, sf_dir, "green")
    cast = cast_columns(raw, {name: kind for name, kind in RAW_GREEN_CASTS.items() if name in raw.columns})
    return cast.select("fare_amount", *[name for name in RAW_GREEN_CASTS if name in cast.columns])


@query
def conform_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_trips(spark, sf_dir, "yellow"), COLOURS["yellow"], F.col(FILE_NAME))


@query
def conform_green_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_trips(spark, sf_dir, "green"), COLOURS["green"], F.col(FILE_NAME))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(table(spark, sf_dir, "lineitem"))


@query
def null_profile_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(raw_trips(spark, sf_dir, "yellow"))


@query
def footer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and bounds of lineitem without reading a column."""
    return profile.footer_profile(spark, f"{sf_dir}/lineitem.parquet")


@query
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_profile(table(spark, sf_dir, "lineitem"))


# Order


@query
def sorted_by_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, whole, in order of their end, each with its place."""
    raw = raw_trips(spark, sf_dir, "yellow", row="_row")
    keyed = raw.select(trip_key(raw, COLOURS["yellow"]).alias("unique_id"), *raw.columns)
    order = ["tpep_dropoff_datetime", "unique_id", "tip_amount", "total_amount", "store_and_fwd_flag", "_row"]
    return number_sorted_rows(keyed, order, "place").drop("_row")


@query
def preview_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(trips(spark, sf_dir), 100, ["dropoff_datetime", "fare_amount", "total_amount", "vendor_id"])


@query
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_file_rows(table(spark, sf_dir, "lineitem"))


@query
def csv_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three gzip CSV loads of different size, numbered in the order they are named."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "csv")
    third = F.col("o_orderkey") % 10
    parts = {"b": third < 3, "c": third == 3, "a": third > 3}
    for name, rows in parts.items():
        write_csv_gz(orders.where(rows).orderBy("o_orderkey"), f"{root}/{name}")
    paths = [f"{root}/{name}" for name in parts]
    return number_file_rows(read_csv(spark, orders.schema, *paths, with_places=True), paths=paths)


# Files and tables


@query
def csv_gz_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "csv")
    write_csv_gz(lines, path)
    return read_csv(spark, lines.schema, path)


@query
def inferred_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders through CSV without a schema; some prices and priorities are spelled as missing."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 7 == 0, "N/A").otherwise(F.col("o_totalprice").cast("string"))
    priority = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).otherwise("NULL")
    path = scratch_path(spark, "csv")
    write_csv_gz(orders.withColumns({"o_totalprice": price, "o_orderpriority": priority}), path)
    return read_inferred_csv(spark, path)


@query
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "tsv")
    write_tsv(lines, path)
    return read_tsv(spark, path, lines.schema)


@query
def tsv_staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed trips through bulk-load text, with missing values and exact amounts."""
    fleet = COLOURS["green"]
    path = scratch_path(spark, "tsv")
    write_tsv(conform(raw_trips(spark, sf_dir, "green"), fleet, F.col(FILE_NAME)), path)
    return read_tsv(spark, path, fleet.target)


@query
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "orders"), path)
    return read_parquet(spark, path)


@query
def replace_then_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    copy = _Table(spark, "lines")
    replace_table(table(spark, sf_dir, "orders"), copy.name, copy.location)
    replace_empty(lines, copy.name, copy.location)
    append_table(lines.where(early), copy.name)
    append_table(lines.where(~early | F.col("l_shipdate").isNull()), copy.name)
    return copy.rows(lines.columns)


@query
def truncate_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    copy = _Table(spark, "lines")
    for _ in range(2):
        create_table(spark, copy.name, lines.schema, location=copy.location)
        truncate_table(spark, copy.name)
        append_table(lines, copy.name)
    return copy.rows(lines.columns)


@query
def union_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of a table put together by name; one part lacks a column."""
    lines = table(spark, sf_dir, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return union_all([lines.where(late), lines.where(~late).drop("l_tax")])


@query
def uncompressed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expanded size of gzip text, month by month."""
    path = scratch_path(spark, "sizes")
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn(FILE_NAME, month_file_column("yellow", F.col("o_orderdate"), "csv"))
    write_csv_gz(orders, path, header=False, partition_by=[FILE_NAME])
    month = F.regexp_extract("_metadata.file_path", f"{FILE_NAME}=([^/]+)/", 1)
    return expanded_sizes(spark, path, month)


@query
def csv_month_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yellow CSV files as a table of their own, loaded twice."""
    path = scratch_path(spark, "csv")
    write_csv_gz(raw_trips(spark, sf_dir, "yellow").drop(FILE_NAME), path)
    copy = _Table(spark, "yellow_csv")
    for _ in range(2):
        loads.replace_load_csv(spark, [path], copy.name, copy.location)
    return copy.rows()


# Merges and loads


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    target = lines.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    source = lines.where(F.col("l_shipdate") >= F.lit("1997-06-01").cast("timestamp_ntz"))
    return source, target


@query
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _merge_sides(spark, sf_dir)
    return target.unionByName(merge.unmatched(source, target, LINE_KEY))


@query
def merge_inserted_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _merge_sides(spark, sf_dir)
    return profile.row_count(merge.unmatched(source, target, LINE_KEY))


@query
def first_month_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    return merge.first_month_wins(lines, LINE_KEY, "ship_month")


@query
def load_one_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _Table(spark, "green_month")
    prefix = _month_files(spark, sf_dir, "green")
    for _ in range(2):
        loads.load_month(spark, prefix, "green", 1995, 11, target.name, target.location)
    return target.rows(COLOURS["green"].target.names)


@query
def backfill_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve months of 1995, one merge each, in order."""
    target = _Table(spark, "yellow_year")
    prefix = _month_files(spark, sf_dir)
    loads.backfill_stepwise(spark, prefix, "yellow", (1995, 1), (1995, 12), target.name, target.location)
    return target.rows(COLOURS["yellow"].target.names)


@query
def backfill_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month read together, twice; the last months of the span have no file."""
    target = _Table(spark, "yellow_all")
    prefix = _month_files(spark, sf_dir)
    for _ in range(2):
        loads.backfill(spark, prefix, "yellow", (1995, 1), (2001, 12), target.name, target.location)
    return target.rows(COLOURS["yellow"].target.names)


@query
def backfill_stray_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file whose trips lie in thousands of months."""
    raw = raw_trips(spark, sf_dir, "yellow")
    years = F.make_ym_interval(F.col("PULocationID") * 25 + F.col("DOLocationID"), F.lit(0))
    root = scratch_path(spark, "months")
    strays = raw.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime") + years)
    write_parquet(strays.drop(FILE_NAME), f"{root}/yellow_tripdata_1995-01.parquet")
    target = _Table(spark, "yellow_strays")
    loads.backfill(spark, f"{root}/", "yellow", (1995, 1), (1995, 2), target.name, target.location)
    return target.rows(COLOURS["yellow"].target.names)


@query
def backfill_wrong_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that also lie in files of other months, earlier ones (there twice) and later ones."""
    raw = raw_trips(spark, sf_dir, "yellow")
    zone, own = F.col("PULocationID"), F.col(FILE_NAME)
    early, late = F.lit("yellow_tripdata_1995-02.parquet"), F.lit("yellow_tripdata_2001-01.parquet")
    names = F.when(zone < 5, F.array(own, early, early)).when(zone.between(5, 9), F.array(own, late)).otherwise(F.array(own))
    root = scratch_path(spark, "months")
    write_parquet(raw.withColumn(FILE_NAME, F.explode(names)), root, [FILE_NAME])
    target = _Table(spark, "yellow_wrong")
    loads.backfill(spark, f"{root}/{FILE_NAME}=", "yellow", (1995, 1), (2001, 12), target.name, target.location)
    return target.rows(COLOURS["yellow"].target.names)


@query
def backfill_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip two more times in its file, with a larger tip, and some in a later file: one row per key is asked for."""
    raw = raw_trips(spark, sf_dir, "yellow")
    tip, more = F.col("tip_amount"), F.col("tip_amount") + 1
    own, late = F.col(FILE_NAME), F.lit("yellow_tripdata_2001-12.parquet")
    there = F.struct(own.alias(FILE_NAME), F.array(more, tip, more).alias("_tips"))
    again = F.struct(late.alias(FILE_NAME), F.array(more).alias("_tips"))
    copies = F.when(F.col("PULocationID") < 5, F.array(there, again)).otherwise(F.array(there))
    files = raw.withColumn("_copy", F.explode(copies)).withColumns({name: F.col(f"_copy.{name}") for name in (FILE_NAME, "_tips")})
    root = scratch_path(spark, "months")
    # The copies of a trip lie in one file, so they are made where that file is written.
    rows = gathered(files.drop("_copy"), [FILE_NAME]).withColumn("tip_amount", F.explode("_tips")).drop("_tips")
    with shuffles_freed(spark):
        rows.write.partitionBy(FILE_NAME).parquet(root)
    target = _Table(spark, "yellow_single")
    for _ in range(2):
        loads.backfill(spark, f"{root}/{FILE_NAME}=", "yellow", (1995, 1), (2001, 12), target.name, target.location, dedupe=True)
    return target.rows(COLOURS["yellow"].target.names)


@query
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the history of a target says of a year loaded month by month, and of the whole span loaded after it."""
    target = _Table(spark, "yellow_history")
    prefix = _month_files(spark, sf_dir)
    loads.backfill_stepwise(spark, prefix, "yellow", (1995, 1), (1995, 12), target.name, target.location)
    loads.backfill(spark, prefix, "yellow", (1995, 1), (2001, 12), target.name, target.location)
    history = publish.load_history(spark, target.name).select("label", "offered", "inserted")
    rows = history.collect()  # a row per load
    target.rows()
    return spark.createDataFrame(rows, history.schema)


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a backfill was offered and inserted, and that its repetition inserted."""
    target = _Table(spark, "yellow_metrics")
    prefix = _month_files(spark, sf_dir)
    runs = [
        loads.backfill(spark, prefix, "yellow", (1995, 1), (2001, 12), target.name, target.location)
        for _ in range(2)
    ]
    target.rows()
    counts = (runs[0].offered, runs[0].inserted, runs[1].inserted)
    return spark.createDataFrame([counts], "offered bigint, first_run bigint, second_run bigint")


@query
def stream_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three waves of two gzip CSV files, numbered on and on; the second wave is delivered twice, as after a crash."""
    orders = table(spark, sf_dir, "orders")
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    target = _Table(spark, "numbered_orders")
    for wave in range(3):
        for part in range(2):
            rows = orders.where(F.col("o_orderkey") % 6 == 2 * wave + part).orderBy("o_orderkey")
            write_csv_gz(rows, f"{arrivals}/{wave}-{part}")
        for again in range(2 if wave == 1 else 1):
            if again:
                # The stream's own note that the last micro-batch is done; without it the batch is run once more.
                remove_path(spark, f"{checkpoint}/commits/1")
            append_stream(spark, arrivals, orders.schema, target.name, checkpoint, location=target.location).awaitTermination()
    return target.rows(["index", *orders.columns])


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in two waves, the second with trips delivered before under another file name."""
    raw = raw_trips(spark, sf_dir, "yellow")
    schema = T.StructType([field for field in raw.schema.fields if field.name != FILE_NAME])
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    target = _Table(spark, "yellow_stream")
    year = F.year("tpep_pickup_datetime")
    again = raw.where(year == 1997).withColumn(FILE_NAME, F.lit("yellow_tripdata_2099-01.parquet"))
    waves = [raw.where(year < 1998), raw.where(year >= 1998).unionByName(again)]
    for wave in [*waves, None]:
        if wave is not None:
            write_parquet(wave, arrivals, [FILE_NAME], mode="append")
        ingest_stream(
            spark, arrivals, schema, "yellow", target.name, checkpoint, None, target.location
        ).awaitTermination()
    return target.rows(COLOURS["yellow"].target.names)


@query
def stream_ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip CSV files, one per micro-batch: all trips in the file of their quarter."""
    raw = raw_trips(spark, sf_dir, "yellow")
    schema = T.StructType([field for field in raw.schema.fields if field.name != FILE_NAME])
    quarter = F.lpad((F.quarter("tpep_pickup_datetime") * 3).cast("string"), 2, "0")
    name = F.concat(F.lit("yellow_tripdata_1995-"), quarter, F.lit(".csv.gz"))
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    target = _Table(spark, "yellow_stream")
    # Copies of a trip go in together only if they come in one micro-batch, so a quarter must be one file.
    write_csv_gz(raw.withColumn(FILE_NAME, name), arrivals, partition_by=[FILE_NAME], whole=True)
    for _ in range(2):
        ingest_stream(
            spark, arrivals, schema, "yellow", target.name, checkpoint, 1, target.location, "csv"
        ).awaitTermination()
    return target.rows(COLOURS["yellow"].target.names)
