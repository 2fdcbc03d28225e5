"""Exact groups against grouping by the text itself."""

import hashlib
import random

import duckdb
import pytest

from fareloom.llm import exact
from fareloom.llm.queries import ORACLES, op5_exact_dedup
from fareloom.llm.tables import PLACE


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def groups(df):
    return sorted(tuple(r) for r in exact.exact_duplicates(df).drop(*PLACE).collect())


def brute(rows):
    found = {}
    for key, text in rows:
        found.setdefault(lowered(text), []).append(key)
    return sorted(
        (key, max(found[lowered(text)]), len(found[lowered(text)]), key == max(found[lowered(text)]),
         hashlib.sha256(lowered(text).encode()).hexdigest())
        for key, text in rows
    )


@pytest.fixture
def small_blocks(monkeypatch, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.shuffle.partitions", "7")


def test_groups_equal_grouping_by_text(spark, small_blocks):
    rng = random.Random(4)
    base = ["é" * rng.randint(0, 9000) + rng.choice(["a", "A", "É"]) for _ in range(40)]
    base += ["x" * 2048, "x" * 2049, "X" * 4096, "x" * 4096, "", None, "xy" * 6000, "xy" * 5999 + "xz"]
    rows = [(i, rng.choice(base)) for i in range(400)] + [(400 + i, "one and the same text") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert groups(df) == brute(rows)


def test_equal_fingerprints_do_not_make_equal_names(spark, small_blocks, monkeypatch):
    from pyspark.sql import functions as F

    hashed = F.xxhash64
    # Places of rows keep their hash; all blocks and pairs get the same one.
    constant = lambda *key: hashed(*key) if "file_path" in key[0] else F.lit(7).cast("long")
    monkeypatch.setattr(exact.F, "xxhash64", constant)
    rows = [(i, f"text {i % 9}" * (1 + 500 * (i % 2))) for i in range(120)]
    assert groups(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_repeated_rows_nulls_and_other_columns(spark):
    rows = [(1, "a", "x"), (1, "A", "y"), (None, "a", "z"), (None, None, "z"), (2, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _name string")
    got = exact.exact_duplicates(df).drop(*PLACE).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in got) == [(0, 1, 3), (0, 2, 2), (1, 1, 3), (1, 1, 3), (2, 2, 2)]
    assert sum(r.kept for r in got) == 2
    left = exact.without_duplicates(df)
    assert left.columns == df.columns and left.count() == 2
    assert exact.without_duplicates(df.limit(0)).count() == 0
    assert exact.exact_duplicates(df.limit(0)).count() == 0


def test_query_equals_sql(spark, sf_dir):
    ours = op5_exact_dedup(spark, sf_dir)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    theirs = duck.sql(ORACLES["op5_exact_dedup"]).project(", ".join(ours.columns)).fetchall()
    assert sorted(map(tuple, ours.collect())) == sorted(theirs)
