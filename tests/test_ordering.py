from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from fareloom.operators import ordering
from fareloom.sources.files import read_csv_text


def test_top_n_puts_null_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0)], "z string, v double")
    assert [tuple(r) for r in ordering.top_n(df, "v", 3, "z").collect()] == [("b", None), ("c", 3.0), ("d", 3.0)]


def test_sort_puts_missing_times_last(spark):
    moments = [datetime(2020, 1, 2), None, datetime(2020, 1, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(moments)], "i int, t timestamp_ntz")
    assert [r.i for r in ordering.sort_by(df, "t").collect()] == [2, 0, 1]
    assert [r.i for r in ordering.preview(df, 2, ["t"]).collect()] == [2, 0]


def test_numbers_follow_the_lines_of_a_file(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "200")
    (tmp_path / "a.csv").write_text("v\n" + "".join(f"line-{i}\n" for i in range(200)))
    scan = read_csv_text(spark, str(tmp_path))
    assert scan.rdd.getNumPartitions() > 3
    assert rows(ordering.number_file_rows(scan)) == sorted(((i, f"line-{i}") for i in range(200)), key=repr)


def numbered(df):
    return [v for _, v in sorted((r["index"], r.v) for r in df.collect())]


def test_numbers_run_on_in_the_order_of_the_paths(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "200")
    sizes = {"b b": 3, "a": 300, "c": 50}
    for name, count in sizes.items():
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{name}{i:03d}\n" for i in range(count)))
    paths = [str(tmp_path / f"{name}.csv") for name in sizes]
    scan = read_csv_text(spark, *paths, with_places=True)
    found = ordering.number_file_rows(scan, paths=paths)
    assert sorted(r["index"] for r in found.collect()) == list(range(353))
    assert numbered(found) == [f"{name}{i:03d}" for name, count in sizes.items() for i in range(count)]
    by_name = ordering.number_file_rows(read_csv_text(spark, str(tmp_path)))
    assert numbered(by_name) == [f"{name}{i:03d}" for name in sorted(sizes) for i in range(sizes[name])]


def test_numbers_of_folders_and_of_different_headers(spark, tmp_path):
    for name, head in (("late", "v"), ("early", "w,v")):
        (tmp_path / name).mkdir()
        for part in range(3):
            lines = "".join(f"{'1,' if ',' in head else ''}{name}{part}{i}\n" for i in range(4))
            (tmp_path / name / f"part-{part}.csv").write_text(f"{head}\n{lines}")
    paths = [f"file://{tmp_path}/late", str(tmp_path / "early")]
    found = ordering.number_file_rows(read_csv_text(spark, *paths, with_places=True), paths=paths)
    assert numbered(found) == [f"{name}{part}{i}" for name in ("late", "early") for part in range(3) for i in range(4)]


def test_numbers_do_not_depend_on_how_files_are_cut(spark, tmp_path, setting):
    """The number of cores, and with it the cut, changes between the call and the run."""
    spark.range(200_000).repartition(5).write.parquet(str(tmp_path / "rows"))
    for before, after in (("4", "9"), ("4", "3")):
        setting("spark.sql.files.minPartitionNum", before)
        found = ordering.number_file_rows(spark.read.parquet(str(tmp_path / "rows")))
        setting("spark.sql.files.minPartitionNum", after)
        assert found.agg(F.count("index"), F.count_distinct("index"), F.max("index")).first() == (200_000, 200_000, 199_999)


def test_numbers_of_sorted_rows(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b"))
    found = rows(ordering.number_sorted_rows(df, ["b", "a"], "place"))
    ordered = sorted((r.b, r.a) for r in df.collect())
    assert found == sorted(((i, a, b) for i, (b, a) in enumerate(ordered)), key=repr)


def test_a_shared_value_is_cut_into_several_ranges(spark, setting):
    setting("spark.sql.adaptive.enabled", "false")
    df = spark.range(4000).select(F.lit(1).alias("t"), F.col("id").alias("row"))
    found = ordering.number_sorted_rows(df, ["t", "row"])
    assert sorted(r["index"] for r in found.collect()) == list(range(4000))
    per_task = ordering.sort_by(df, "t", "row").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_task) < 2000


def test_parquet_rows_are_numbered_without_being_written(spark, tmp_path, setting):
    """Footers tell how many rows a file has, the files themselves number theirs."""
    setting("spark.sql.files.maxPartitionBytes", "4000")
    for name, first, count in (("b", 0, 2000), ("a", 2000, 700), ("c", 2700, 1)):
        spark.range(first, first + count, 1, 1).select(F.concat(F.lit("v"), F.col("id")).alias("v"), "id").write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / name) for name in ("b", "a", "c")]
    found = ordering.number_file_rows(spark.read.parquet(*paths), paths=paths)
    assert found.columns == ["index", "v", "id"]
    assert found.where("index = id").count() == 2701 and found.select("index").distinct().count() == 2701
    assert "placed" not in "".join(found.inputFiles())
    by_name = ordering.number_file_rows(spark.read.parquet(*paths))
    assert by_name.where("id = 2000").first()["index"] == 0 and by_name.where("id = 0").first()["index"] == 700
