import bz2
import gzip
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fareloom.plans import reports
from fareloom.schemas import RAW_YELLOW
from fareloom.sinks.files import read_tsv, write_csv_gz, write_parquet, write_tsv
from fareloom.sources import files
from fareloom.sources.sizes import expanded_sizes


def gz(path, text):
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_typed_csv_by_name(spark, tmp_path):
    """Column order of the file, ``1.0`` as an integer, several spellings of a missing value."""
    path = gz(
        tmp_path / "yellow_tripdata_2021-01.csv.gz",
        "trip_distance,VendorID,tpep_pickup_datetime,store_and_fwd_flag,passenger_count,extra_column\n"
        "1.5,1.0,2021-01-01 00:30:10,N,2,a\n"
        "NA,,2021-01-01 00:51:20.5,N/A,null,b\n",
    )
    df = files.read_yellow_csv(spark, path)
    assert df.dtypes == [
        ("trip_distance", "double"),
        ("VendorID", "bigint"),
        ("tpep_pickup_datetime", "timestamp_ntz"),
        ("store_and_fwd_flag", "string"),
        ("passenger_count", "bigint"),
        ("extra_column", "string"),
    ]
    assert rows(df) == sorted(
        [
            (1.5, 1, datetime(2021, 1, 1, 0, 30, 10), "N", 2, "a"),
            (None, None, datetime(2021, 1, 1, 0, 51, 20, 500000), None, None, "b"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("line", ["1.5,2021-01-01", "x,2021-01-01", "1,yesterday"])
def test_typed_csv_refuses_what_does_not_fit(spark, tmp_path, line):
    path = tmp_path / "bad.csv"
    path.write_text(f"VendorID,tpep_pickup_datetime\n{line}\n")
    with pytest.raises(Exception, match="not an integer|CAST_INVALID_INPUT"):
        files.read_csv(spark, RAW_YELLOW, str(path)).collect()


def test_zone_lookup(spark, tmp_path):
    path = tmp_path / "taxi_zone_lookup.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n264,"Unknown","N/A","N/A"\n')
    df = files.read_zones_csv(spark, str(path))
    assert rows(df) == [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", None, None)]


def test_inferred_csv(spark, tmp_path):
    """Missing-value tokens fit any type, and a column of nothing else stays text."""
    path = tmp_path / "x.csv"
    path.write_text(
        "a,b,c,d,e,f\n1,x,1.5,2020-01-02 03:04:05,true,NA\nN/A,N/A,2,NULL,False,\n 3,NA,1e3,2021-01-02 03:04:05.5,nan,null\n"
    )
    found = files.read_inferred_csv(spark, str(path))
    kinds = ["bigint", "string", "double", "timestamp_ntz", "boolean", "string"]
    assert found.dtypes == list(zip("abcdef", kinds))
    assert [tuple(r)[:3] for r in found.collect()] == [(1, "x", 1.5), (None, None, 2.0), (3, None, 1000.0)]
    assert [(r.d and r.d.year, r.e, r.f) for r in found.collect()] == [(2020, True, None), (None, False, None), (2021, None, None)]


def test_inferred_csv_keeps_long_whole_numbers(spark, tmp_path):
    path = tmp_path / "x.csv"
    long = "9" * 40
    path.write_text(f"a,b,c,d\n9223372036854775807,9223372036854775808,{long},1.5\n-9223372036854775808,NA,1,2\n9223372036854775806,7,2,3\n")
    found = files.read_inferred_csv(spark, str(path))
    assert found.dtypes == [("a", "bigint"), ("b", "decimal(38,0)"), ("c", "string"), ("d", "double")]
    assert [r.a for r in found.collect()] == [2**63 - 1, -(2**63), 2**63 - 2]
    assert [(r.b and int(r.b), r.c) for r in found.collect()] == [(2**63, long), (None, "1"), (7, "2")]


def test_literal_table(spark):
    table = files.literal_table(spark, [(1, 3), (2, 4)], "day bigint, num_passengers bigint")
    assert rows(table.withColumn("month", F.lit(5).cast("bigint"))) == [(1, 3, 5), (2, 4, 5)]


def test_csv_texts_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a,b\n1,"say ""hi"", now"\n2,back\\slash\n3,"two\nlines"\n')
    found = rows(files.read_csv_text(spark, str(path), multi_line=True))
    assert found == [("1", 'say "hi", now'), ("2", "back\\slash"), ("3", "two\nlines")]
    df = spark.createDataFrame([("1", 'say "hi", now'), ("2", " back\\slash ")], "a string, b string")
    write_csv_gz(df, str(tmp_path / "out"))
    assert rows(files.read_csv_text(spark, str(tmp_path / "out"))) == rows(df)


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x,z\n4,3,5\n")
    (tmp_path / "c.csv").write_text("x,y\n6,7\n")
    paths = [str(tmp_path / name) for name in ("a.csv", "b.csv", "c.csv")]
    assert rows(files.read_csv_text(spark, *paths)) == [("1", "2", None), ("3", "4", "5"), ("6", "7", None)]
    assert rows(files.read_csv_text(spark, str(tmp_path))) == [("1", "2", None), ("3", "4", "5"), ("6", "7", None)]


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    def frame(count):
        folder = tmp_path / f"{count} files + more"
        folder.mkdir()
        for i in range(count):
            header, line = (("x,y", f"{i},{-i}"), ("y,z", f"{-i},7"))[i % 2]
            (folder / f"{i:03d} a.csv").write_text(f"{header}\n" + f"{line}\n" * 3)
        (folder / "empty.csv").write_text("")
        return files.read_csv_text(spark, *[str(path) for path in sorted(folder.iterdir())])

    few, few_jobs = jobs_of(spark, "few", lambda: frame(4))
    some, some_jobs = jobs_of(spark, "some", lambda: frame(70))
    many, many_jobs = jobs_of(spark, "many", lambda: frame(200))
    # From some number of paths on each scan lists them by a job; no job is for one file.
    assert few_jobs <= some_jobs == many_jobs < 10
    assert many.columns == ["x", "y", "z"] and many.count() == 600
    assert rows(few.distinct()) == rows(spark.createDataFrame([("0", "0", None), (None, "-1", "7"), ("2", "-2", None), (None, "-3", "7")], "x string, y string, z string"))
    _, inferred_jobs = jobs_of(spark, "inferred", lambda: files.read_inferred_csv(spark, *sorted(map(str, (tmp_path / "200 files + more").glob("*.csv")))))
    assert inferred_jobs <= many_jobs + 4


def test_headers_are_read_from_the_beginning_of_files_only(spark, tmp_path):
    big = "v\n" + "1234567\n" * 400_000
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(big if name == "a" else big.replace("v", "w", 1))
    groups = files.files_by_header(spark, [str(tmp_path)])
    assert [[path.rpartition("/")[2] for path in group] for group in groups] == [["a.csv"], ["b.csv"]]
    assert files.files_by_header(spark, [str(tmp_path / "a.csv")]) == [[str(tmp_path / "a.csv")]]


TEXTS = ["plain", "", None, " padded ", 'quote " inside', "tab\tinside", "back\\slash", "NULL", "ünïcode"]


def test_tsv_round_trip_keeps_texts(spark, tmp_path):
    data = [(i, text, datetime(2020, 1, 1, 0, 0, 0, 123456)) for i, text in enumerate(TEXTS)]
    df = spark.createDataFrame(data, "i int, s string, t timestamp_ntz")
    write_tsv(df, str(tmp_path / "t"))
    assert rows(read_tsv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_tsv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "two\nlines"), (2, None)], "i int, s string")
    write_tsv(df, str(tmp_path / "t"))
    assert rows(read_tsv(spark, str(tmp_path / "t"), df.schema, multi_line=True)) == rows(df)


def test_tsv_text_form(spark, tmp_path):
    write_tsv(spark.sql("SELECT 1 a, CAST(NULL AS STRING) b, 'x' c").coalesce(1), str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text() == "1\t\\N\tx\n"


def test_expanded_sizes(spark, tmp_path):
    texts = {"a.csv.gz": "id,name\r\n1,żółw\r\n", "b.csv.gz": "x\n" * 200_000, "c.csv.gz": "\n\n\n"}
    for name, text in texts.items():
        gz(tmp_path / name, text)
    found = {row.file_name: (row.bytes, row.mib) for row in expanded_sizes(spark, str(tmp_path)).collect()}
    assert found == {name: (len(t.encode()), round(len(t.encode()) / 1048576, 1)) for name, t in texts.items()}


def test_expanded_sizes_of_any_content(spark, tmp_path):
    """No last line feed, bytes that are no UTF-8, nothing at all, several members, other compressions, none."""
    latin = "caf\xe9\rna\xefve".encode("latin-1")
    files_ = {
        "a.gz": gzip.compress(latin),
        "b.gz": gzip.compress(b""),
        "c.gz": gzip.compress(b"x" * 3_000_000) + gzip.compress(b"\n"),
        "d.bz2": bz2.compress(latin * 1000),
        "e e.csv": latin,
        "f.gz": b"",
    }
    for name, content in files_.items():
        (tmp_path / name).write_bytes(content)
    found = {row.file_name: row.bytes for row in expanded_sizes(spark, str(tmp_path)).collect()}
    want = {"a.gz": len(latin), "b.gz": 0, "c.gz": 3_000_001, "d.bz2": 1000 * len(latin), "e e.csv": len(latin), "f.gz": 0}
    assert {name.replace("%20", " "): size for name, size in found.items()} == want


def test_absent_path_and_other_failures(spark, tmp_path):
    assert files.read_if_present(spark, str(tmp_path / "none.parquet")) is None
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        files.read_if_present(spark, str(tmp_path / "broken.parquet"))


def test_months_of_different_layouts(spark, tmp_path):
    prefix = f"{tmp_path}/"
    frames = {1: "1 a", 2: "2 a", 4: "CAST(3 AS DOUBLE) a, 'x' b"}
    for month, columns in frames.items():
        spark.sql(f"SELECT {columns}").write.parquet(files.month_path(prefix, "green", 2020, month))
    scans, absent = files.read_months(spark, prefix, "green", [(2020, m) for m in range(1, 5)])
    assert absent == ["green_tripdata_2020-03.parquet"]
    assert sorted(scan.count() for scan in scans) == [1, 2]
    assert files.union_all(scans).columns == ["a", "b"]


def test_partitioned_write_keeps_files_few(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 4).alias("m"))
    write_parquet(df, str(tmp_path / "p"), ["m"])
    assert len(list((tmp_path / "p").rglob("*.parquet"))) < 16
    write_csv_gz(df, str(tmp_path / "c"), partition_by=["m"])
    assert files.read_csv_text(spark, str(tmp_path / "c")).count() == 4000


def test_year_of_csv_files(spark, tmp_path):
    for month, count in ((1, 3), (2, 5), (12, 0)):
        header, line = ("v", "1") if month < 2 else ("w,v", "1,2")
        gz(tmp_path / f"yellow_tripdata_2020-{month:02d}.csv.gz", f"{header}\n" + f"{line}\n" * count)
    found = rows(reports.rows_per_csv_file(spark, f"{tmp_path}/", "yellow", (2020, 1), (2020, 12)))
    assert found == [("yellow_tripdata_2020-01.csv.gz", 3), ("yellow_tripdata_2020-02.csv.gz", 5)]
