import glob
import os
import random
import time
import uuid
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from conftest import rows, yellow_rows
from pyspark.sql import functions as F

from fareloom.operators.conform import conform
from fareloom.plans import loads, registry
from fareloom.plans.registry import QUERIES
from fareloom.schemas import COLOURS, PICKUP_MONTH
from fareloom.session import _FILE_CLEANUP
from fareloom.sinks import publish
from fareloom.sinks.keys import keys_table, known_keys
from fareloom.sinks.tables import table_location, truncate_table
from fareloom.sources.files import month_path

YELLOW = COLOURS["yellow"]


@pytest.fixture
def target(spark):
    names = []

    def new():
        names.append(f"trips_{uuid.uuid4().hex}")
        return names[-1]

    yield new
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}__keys")


@pytest.fixture
def prefix(spark, tmp_path):
    """Four months, March absent; copies inside a month and across months, stray and missing pickups."""
    months = {
        1: [(1, "2020-01-05 10:00:00", 5.0), (1, "2020-01-05 10:00:00", 5.0), (2, "2020-01-31 23:59:59", 6.0),
            (3, None, 1.0)],
        2: [(1, "2020-01-05 10:00:00", 5.0), (4, "2020-02-01 00:00:00", 7.0), (3, None, 1.0), (None, None, None)],
        4: [(5, "2002-12-31 22:00:00", 8.0), (5, "2002-12-31 22:00:00", 8.0), (4, "2020-02-01 00:00:00", 7.0)],
    }
    for month, trips in months.items():
        raw = yellow_rows(spark, *trips)
        if month == 4:
            # A later layout: another spelling, another type, one column more.
            raw = raw.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).withColumn(
                "Airport_fee", F.lit(1.25)
            )
        raw.coalesce(1).write.parquet(month_path(f"{tmp_path}/", "yellow", 2020, month))
    return f"{tmp_path}/"


def test_month_load_is_insert_only_and_repeatable(spark, prefix, target):
    name = target()
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 4
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 0
    report = loads.load_month(spark, prefix, "yellow", 2020, 2, name)
    assert (report.offered, report.inserted) == (4, 2) and report.rows_per_second > 0
    skipped = loads.load_month(spark, prefix, "yellow", 2020, 3, name)
    assert skipped.inserted == 0 and skipped.absent == ["yellow_tripdata_2020-03.parquet"]
    loaded = loads.target_rows(spark, name, YELLOW)
    assert loaded.columns == YELLOW.target.names
    assert rows(loaded.groupBy("file_name").count()) == [
        ("yellow_tripdata_2020-01.parquet", 4),
        ("yellow_tripdata_2020-02.parquet", 2),
    ]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_backfill_equals_month_by_month(spark, prefix, target, setting, broadcast):
    setting("spark.sql.autoBroadcastJoinThreshold", broadcast)
    at_once, stepwise = target(), target()
    span = ("yellow", (2020, 1), (2020, 4))
    report = loads.backfill(spark, prefix, *span, at_once)
    reports = loads.backfill_stepwise(spark, prefix, *span, stepwise)
    assert [r.inserted for r in reports] == [4, 2, 0, 2]
    assert report.inserted == 8 and report.absent == ["yellow_tripdata_2020-03.parquet"]
    assert rows(loads.target_rows(spark, at_once, YELLOW)) == rows(loads.target_rows(spark, stepwise, YELLOW))
    assert loads.backfill(spark, prefix, *span, at_once).inserted == 0
    by_fee = spark.table(at_once).groupBy("airport_fee").count()
    assert {(float(fee), n) for fee, n in by_fee.collect()} == {(0.0, 6), (1.25, 2)}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_random_months(spark, tmp_path, target, setting, broadcast):
    """Many copies within and across files, in the wrong month and without a pickup time."""
    setting("spark.sql.autoBroadcastJoinThreshold", broadcast)
    dice = random.Random(20)
    pickups = [None, *(f"2020-0{month}-0{day} 08:00:00" for month in (1, 2, 3) for day in (1, 2))]
    for month in (1, 2, 3):
        trips = [
            (dice.choice([None, 1, 2]), dice.choice(pickups), dice.choice([None, 1.5, 2.5])) for _ in range(60)
        ]
        yellow_rows(spark, *trips).write.parquet(month_path(f"{tmp_path}/", "yellow", 2020, month))
    at_once, stepwise = target(), target()
    span = ("yellow", (2020, 1), (2020, 3))
    report = loads.backfill(spark, f"{tmp_path}/", *span, at_once)
    steps = loads.backfill_stepwise(spark, f"{tmp_path}/", *span, stepwise)
    assert report.inserted == sum(step.inserted for step in steps) < 180
    assert rows(loads.target_rows(spark, at_once, YELLOW)) == rows(loads.target_rows(spark, stepwise, YELLOW))


def test_backfill_after_some_months(spark, prefix, target):
    name = target()
    loads.load_month(spark, prefix, "yellow", 2020, 2, name)
    assert loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), name).inserted == 3
    truncate_table(spark, name)
    assert loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), name).inserted == 8


def test_target_outlives_its_catalog_entry(spark, prefix, target, tmp_path):
    """A new catalog finds the rows at the location, so a repeated load still adds nothing."""
    first, second = target(), target()
    location = str(tmp_path / "target")
    loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), first, location)
    spark.sql(f"DROP TABLE {first}")
    assert loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), second, location).inserted == 0
    assert spark.table(second).count() == 8


def test_thousands_of_months_in_one_file(spark, tmp_path, target):
    """Partitions follow the files, not the times in them; a repeated load finds every key."""
    trips = [(i, f"{1500 + i // 12:04d}-{1 + i % 12:02d}-05 10:00:00", 1.0) for i in range(900)]
    trips += [(1, "2020-01-05 10:00:00", 1.0), (2, None, 1.0)]
    yellow_rows(spark, *trips, *trips[:5]).repartition(6).write.parquet(month_path(f"{tmp_path}/", "yellow", 2020, 1))
    name = target()
    for inserted in (907, 0):
        assert loads.load_month(spark, f"{tmp_path}/", "yellow", 2020, 1, name).inserted == inserted
    listed = [row[0].split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert len(listed) <= 1 + loads.STRAY_PARTS and "pickup_month=2020-01" in listed
    of_month = loads.target_rows(spark, name, YELLOW, ["2020-01", "1500-01"])
    assert rows(of_month.groupBy("vendor_id").count()) == [(0, 2), (1, 1)]


def test_strays_and_their_months_meet(spark, tmp_path, target):
    """A key that lies among the strays of one load and in its month in another, either way round."""
    prefix = f"{tmp_path}/"
    months = {1: (1, "2020-02-05 10:00:00", 1.0), 2: (1, "2020-02-05 10:00:00", 1.0), 3: (2, "2020-04-05 10:00:00", 1.0), 4: (2, "2020-04-05 10:00:00", 1.0)}
    for month, trip in months.items():
        yellow_rows(spark, trip, (3, None, 1.0)).coalesce(1).write.parquet(month_path(prefix, "yellow", 2020, month))
    name = target()
    inserted = [loads.load_month(spark, prefix, "yellow", 2020, month, name).inserted for month in (1, 2, 4, 3)]
    assert inserted == [2, 0, 1, 0]


def test_a_long_month_is_written_in_parts(spark, tmp_path, target, setting):
    """A month with nine tenths of the rows does not end in one task."""
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    setting("spark.sql.shuffle.partitions", "16")
    trips = [(i, f"2020-0{1 + (i % 10 == 0)}-05 10:00:00", float(i % 3)) for i in range(3000)]
    yellow_rows(spark, *trips).repartition(16).write.parquet(month_path(f"{tmp_path}/", "yellow", 2020, 1))
    name = target()
    assert loads.load_month(spark, f"{tmp_path}/", "yellow", 2020, 1, name).inserted == 3000
    sizes = [r["count"] for r in spark.table(name).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_a_load_that_broke_off_is_finished_once(spark, prefix, target, monkeypatch):
    """The process ends after the commit, before the catalog knows: the next load tells it."""
    name = target()
    with monkeypatch.context() as patched:
        patched.setattr(publish, "_add_partitions", broken)
        with pytest.raises(RuntimeError, match="gone"):
            loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    assert spark.table(name).count() == 0
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 0
    assert spark.table(name).count() == 4
    assert loads.load_month(spark, prefix, "yellow", 2020, 2, name).inserted == 2


def broken(*_):
    raise RuntimeError("gone")


@pytest.mark.parametrize("step", ["_without_known", "end_load"])
def test_a_load_that_broke_off_before_its_commit_leaves_nothing(spark, prefix, target, monkeypatch, step):
    name = target()
    with monkeypatch.context() as patched:
        patched.setattr(loads, step, broken)
        with pytest.raises(RuntimeError, match="gone"):
            loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    assert spark.table(name).count() == 0 and publish.load_history(spark, name).count() == 0
    location = table_location(spark, name)
    assert not publish._names(spark, f"{location}/loads")
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 4


def test_files_stay_where_they_were_written(spark, prefix, target, monkeypatch):
    """Publishing moves nothing: the files of the table are those that the write has left, untouched."""
    name = target()
    seen = {}

    def looked(session, load, part):
        found = staged(session, load, part)
        seen[part] = {f: os.stat(f).st_mtime_ns for f in glob.glob(load.path(part).removeprefix("file:") + "/*/*.parquet")}
        return found

    staged = publish.staged_partitions
    monkeypatch.setattr(loads, "staged_partitions", looked)
    for month, part in ((1, "all"), (2, "fresh")):
        loads.load_month(spark, prefix, "yellow", 2020, month, name)
        now = {f.removeprefix("file://") for f in spark.table(name).inputFiles()}
        assert seen[part] and seen[part].keys() <= now
        assert all(os.stat(f).st_mtime_ns == at for f, at in seen[part].items())
    assert len(now) == sum(len(glob.glob(f"{table_location(spark, name).removeprefix('file:')}/loads/*/{p}/*/*.parquet")) for p in ("all", "fresh"))


def test_a_second_writer_is_noticed(spark, prefix, target, monkeypatch):
    name = target()
    compare = loads._without_known

    def meanwhile(*given):
        monkeypatch.setattr(loads, "_without_known", compare)
        loads.load_month(spark, prefix, "yellow", 2020, 1, name)
        return compare(*given)

    loads.create_target(spark, name, YELLOW)
    monkeypatch.setattr(loads, "_without_known", meanwhile)
    with pytest.raises(publish.ConcurrentLoad):
        loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    assert spark.table(name).count() == 4
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 0


def test_files_of_a_foreign_load_are_kept_for_a_day(spark, prefix, target, monkeypatch):
    name = target()
    loads.create_target(spark, name, YELLOW)
    with monkeypatch.context() as patched:
        patched.setattr(publish, "_process", lambda _: "f0e1d2c3b4a5")
        foreign = publish.begin_load(spark, name)
    publish._RUNNING.discard(foreign.load_id)
    publish._put(spark, foreign.path("all/pickup_month=2020-01/x.parquet"), "rows")
    loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    assert publish._names(spark, foreign.path("all"))
    monkeypatch.setattr(publish, "STALE_SECONDS", -1)
    loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    assert not publish._names(spark, foreign.path("all")) and spark.table(name).count() == 4


def test_history_has_a_row_per_load(spark, prefix, target):
    name = target()
    loads.backfill_stepwise(spark, prefix, "yellow", (2020, 1), (2020, 4), name)
    loads.load_month(spark, prefix, "yellow", 2020, 2, name)
    history = publish.load_history(spark, name).orderBy("started").collect()
    files = [f"yellow_tripdata_2020-0{month}.parquet" for month in (1, 2, 4, 2)]
    assert [(r.label, r.offered, r.inserted) for r in history] == list(zip(files, (4, 4, 3, 4), (4, 2, 2, 0)))
    assert all(r.seconds > 0 for r in history) and len({r.load_id for r in history}) == 4


def test_one_row_per_key_if_asked_for(spark, tmp_path, target):
    """Copies that differ outside the key: the first file's, then the smallest one; whatever the order of rows."""
    prefix, pickup = f"{tmp_path}/", "2020-01-05 10:00:00"
    raw = yellow_rows(spark, (1, pickup, 5.0), (2, pickup, 5.0), (None, None, None))
    copies = raw.unionAll(raw.withColumn("payment_type", F.lit(7).cast("bigint"))).unionAll(raw)
    copies.repartition(5).write.parquet(month_path(prefix, "yellow", 2020, 1))
    raw.withColumn("payment_type", F.lit(0).cast("bigint")).write.parquet(month_path(prefix, "yellow", 2020, 2))
    name, all_in = target(), target()
    report = loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 2), name, dedupe=True)
    assert (report.offered, report.inserted) == (12, 3)
    got = loads.target_rows(spark, name, YELLOW).select("vendor_id", "file_name", "payment_type")
    assert rows(got) == [(v, "yellow_tripdata_2020-01.parquet", 1) for v in (0, 1, 2)]
    assert loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 2), name, dedupe=True).inserted == 0
    assert loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 2), all_in).inserted == 9


def test_a_day_is_found_without_reading_the_month(spark, tmp_path, target):
    """Rows lie in order of their end, so row groups of other days are skipped."""
    start = datetime(2020, 1, 1)
    schema = yellow_rows(spark).schema
    trips = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("n"))
    raw = yellow_rows(spark, (1, "2020-01-05 10:00:00", 5.0)).crossJoin(trips.coalesce(1))
    minutes = F.make_dt_interval(mins=(F.col("n") * 2).cast("int"))
    raw = raw.withColumns({"tpep_pickup_datetime": F.lit(start) + minutes, "tpep_dropoff_datetime": F.lit(start) + minutes})
    raw.select(*schema.names).write.parquet(month_path(f"{tmp_path}/", "yellow", 2020, 1))
    name = target()
    small = {"parquet.block.size": "65536", "parquet.page.size": "4096", "parquet.page.size.row.check.min": "100", "parquet.block.size.row.check.min": "100"}
    conf = spark._jsc.hadoopConfiguration()
    for key, value in small.items():
        conf.set(key, value)
    try:
        loads.load_month(spark, f"{tmp_path}/", "yellow", 2020, 1, name)
    finally:
        for key in small:
            conf.unset(key)
    groups = [
        (group.statistics.min, group.statistics.max)
        for path in spark.table(name).inputFiles()
        for meta in [pq.ParquetFile(path.removeprefix("file://")).metadata]
        for i in range(meta.num_row_groups)
        for group in [next(c for c in map(meta.row_group(i).column, range(meta.num_columns)) if c.path_in_schema == "tpep_dropoff_datetime")]
    ]
    day = datetime(2020, 1, 10), datetime(2020, 1, 11)
    assert len(groups) > 8
    assert sum(low < day[1] and high >= day[0] for low, high in groups) <= len(groups) / 4


def test_nothing_to_load(spark, prefix, target):
    report = loads.backfill(spark, prefix, "yellow", (2021, 1), (2021, 2), target())
    assert report.inserted == 0 and len(report.absent) == 2


def test_merge_reads_only_the_months_of_the_batch(spark, prefix, target):
    name = target()
    loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), name)
    batch = spark.table(name).select("unique_id", "file_name", PICKUP_MONTH, YELLOW.pickup)

    def read(*values):
        found = loads._stored_keys(spark, batch, [f"pickup_month={value}" for value in values], name, YELLOW)
        return {row[0] for row in found.select(PICKUP_MONTH).distinct().collect()}

    assert read("2020-02") == {"2020-02", "stray-"} and read("2019-07") == {"stray-"}
    # A stray of the batch was picked up in January, others in a month that the target lacks.
    batch = batch.unionAll(batch.where("pickup_month = '2020-01'").withColumn(PICKUP_MONTH, F.lit("stray-03")))
    assert read("2020-02", "stray-03") == {"2020-01", "2020-02", "stray-"}
    plain = target()
    loads.merge_into(spark, _one_trip(spark), _created(spark, plain), YELLOW)
    assert loads._stored_keys(spark, batch, ["pickup_month=2019-01"], plain, YELLOW) is None


def _created(spark, name, **more):
    loads.create_target(spark, name, YELLOW, **more)
    return name


def _one_trip(spark, n=1):
    raw = yellow_rows(spark, *[(i, "2020-01-05 10:00:00", 5.0) for i in range(n)])
    return conform(raw, YELLOW, F.lit("yellow_tripdata_2020-01.parquet"))


def test_known_keys_are_read_in_place(spark, target, setting):
    """No exchange above the index: only the batch's keys are dealt, like the buckets."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = _created(spark, target(), key_buckets=5)
    hot = _one_trip(spark, 40).unionAll(_one_trip(spark, 1).join(spark.range(300), how="cross").drop("id"))
    assert loads.merge_into(spark, hot, name, YELLOW).inserted == 340
    index = spark.table(keys_table(name))
    assert index.count() == 40 and len(index.inputFiles()) <= 5
    batch = _one_trip(spark, 60)
    known = known_keys(spark, batch, index, name)
    assert known.count() == 40
    known.collect()
    plan = known._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("Bucketed: true")
    above = plan[plan.rindex("SortMergeJoin", 0, scan) : scan]
    assert "Exchange" not in above and "FileScan" in above
    assert loads.merge_into(spark, batch, name, YELLOW).inserted == 20


def test_other_tables_of_that_name_are_left_alone(spark, target):
    name = target()
    spark.range(3).write.saveAsTable(f"{name}__keys")
    with pytest.raises(ValueError, match="in use"):
        loads.create_target(spark, name, YELLOW)
    plain = target()
    spark.range(3).write.saveAsTable(plain)
    spark.range(3).write.saveAsTable(f"{plain}__keys")
    truncate_table(spark, plain)
    assert spark.table(f"{plain}__keys").count() == 3 and spark.table(plain).count() == 0


def test_the_index_is_made_anew_from_the_log(spark, prefix, target):
    name = target()
    loads.load_month(spark, prefix, "yellow", 2020, 1, name)
    spark.sql(f"DROP TABLE {keys_table(name)}")
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 0
    truncate_table(spark, name)
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, name).inserted == 4
    assert spark.table(keys_table(name)).count() == 3


def test_replaced_csv_month(spark, tmp_path, target):
    name = target()
    path = tmp_path / "yellow_tripdata_2021-01.csv"
    path.write_text("VendorID,fare_amount\n1,2.5\n2,3.5\n")
    for with_index, columns in ((False, ["VendorID", "fare_amount"]), (True, ["index", "VendorID", "fare_amount"])):
        loads.replace_load_csv(spark, [str(path)], name, with_index=with_index)
        assert spark.table(name).columns == columns
        assert spark.table(name).count() == 2
    assert rows(spark.table(name)) == [(0, 1, 2.5), (1, 2, 3.5)]


def test_tables_for_reports(spark, tmp_path, target):
    trips, zones = target(), target()
    spark.createDataFrame(
        [(1.0, datetime(2025, 11, 18, 9), 3, 9.5)],
        "VendorID double, lpep_pickup_datetime timestamp_ntz, PULocationID int, total_amount double",
    ).write.parquet(str(tmp_path / "green.parquet"))
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n3,Bronx,Allerton,Boro Zone\n")
    for _ in range(2):
        loads.load_for_reports(spark, [str(tmp_path / "green.parquet")], [str(tmp_path / "zones.csv")], trips, zones)
    assert dict(spark.table(trips).dtypes)["VendorID"] == "bigint"
    answer = spark.sql(
        f"""
        SELECT z."Zone", sum(t."total_amount") AS total FROM {trips} t
        JOIN {zones} z ON t."PULocationID" = z."LocationID"
        WHERE CAST(t.lpep_pickup_datetime AS DATE) = '2025-11-18' GROUP BY z."Zone"
        """
    )
    assert rows(answer) == [("Allerton", 9.5)]


def test_the_index_of_many_months_has_few_files(spark, tmp_path, target):
    """Files per bucket and year, not per bucket and month; months are still told apart by the loads that have them."""
    trips = [(i, f"{2018 + i % 2}-{1 + i // 2 % 12:02d}-05 10:00:00", 1.0 + i) for i in range(480)]
    rows_ = yellow_rows(spark, *trips)
    for year in (2018, 2019):
        for month in range(1, 13):
            one = rows_.where(F.date_format("tpep_pickup_datetime", "yyyy-MM") == f"{year}-{month:02d}")
            one.coalesce(1).write.parquet(month_path(f"{tmp_path}/", "yellow", year, month))
    name = _created(spark, target(), key_buckets=3)
    assert loads.backfill(spark, f"{tmp_path}/", "yellow", (2018, 1), (2019, 12), name).inserted == 480
    assert len(spark.table(keys_table(name)).inputFiles()) <= 2 * 3
    assert loads.backfill(spark, f"{tmp_path}/", "yellow", (2018, 1), (2019, 12), name).inserted == 0
    assert loads.load_month(spark, f"{tmp_path}/", "yellow", 2019, 2, name).inserted == 0
    batch = spark.table(name).select("unique_id", "file_name", PICKUP_MONTH, YELLOW.pickup)
    assert loads._stored_keys(spark, batch, ["pickup_month=2019-02"], name, YELLOW).count() > 0
    assert loads._stored_keys(spark, batch, ["pickup_month=2020-02"], name, YELLOW) is None


def test_a_repeated_load_writes_no_row(spark, prefix, target, monkeypatch):
    name = target()
    loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), name)
    monkeypatch.setattr(loads, "_staged", broken)
    for dedupe in (False, True):
        report = loads.backfill(spark, prefix, "yellow", (2020, 1), (2020, 4), name, dedupe=dedupe)
        assert (report.offered, report.inserted) == (11, 0)


@pytest.mark.parametrize("known", [1, 3])
def test_fewer_and_more_known_than_fresh(spark, target, known):
    """Rows meet the smaller set of keys; copies of fresh rows and rows without a key all go in."""
    name = _created(spark, target())
    loads.merge_into(spark, _one_trip(spark, known), name, YELLOW)
    batch = _one_trip(spark, 4)
    keyless = _one_trip(spark, 1).withColumn("unique_id", F.lit(None).cast("string"))
    batch = batch.unionAll(batch).unionAll(keyless).unionAll(keyless)
    report = loads.merge_into(spark, batch, name, YELLOW)
    assert (report.offered, report.inserted) == (10, 2 * (4 - known) + 2)
    assert rows(spark.table(name).where("unique_id IS NOT NULL").groupBy("vendor_id").count()) == [
        (i, 1 if i < known else 2) for i in range(4)
    ]
    again = loads.merge_into(spark, batch, name, YELLOW)
    assert (again.offered, again.inserted) == (10, 2)


def test_one_file_has_no_later_month(spark, prefix, target, monkeypatch):
    """Strays of a single file are not compared with anything."""
    monkeypatch.setattr(loads, "_later_copies", broken)
    assert loads.load_month(spark, prefix, "yellow", 2020, 1, target()).inserted == 4


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("query", ["backfill_wrong_files", "backfill_one_per_key"])
def test_no_shuffle_file_outlives_its_job(spark, sf_dir, setting, query):
    """Shuffle files of a load's steps do not add up on the disk until some garbage collection."""
    setting(_FILE_CLEANUP, "false")
    before = _shuffle_files(spark)
    QUERIES[query](spark, sf_dir)
    for _ in range(100):
        # The files are removed by another thread.
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(_FILE_CLEANUP) == "false"


def test_copies_of_one_per_key_are_made_after_one_join(spark, sf_dir, monkeypatch):
    """The lines are read, and shuffled, once for the files that the load reads."""
    plans = []

    def planned(df, by):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(registry, "gathered", planned)
    QUERIES["backfill_one_per_key"](spark, sf_dir)
    assert len(plans) == 1 and plans[0].count("l_shipdate") and plans[0].count("Union") == 0
