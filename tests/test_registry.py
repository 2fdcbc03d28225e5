"""Every registered query against its SQL, and the joins of the trip view against each other."""

from pathlib import Path

import duckdb
import pytest
from conftest import rows

from __spark_entry__ import entry, oracle_sql, queries
from fareloom.plans.oracles import ORACLES
from fareloom.plans.registry import QUERIES
from fareloom.plans.views import trips

SMALL = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="needs the check tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_names_match():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, str(SMALL))
    theirs = duck.sql(ORACLES[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    quoted = ", ".join(f'"{column}"' for column in columns)
    assert rows(ours.select(*columns)) == sorted(theirs.project(quoted).fetchall(), key=repr)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_trips_without_broadcast(spark, no_broadcast):
    shuffled = rows(trips(spark, str(SMALL)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert shuffled == rows(trips(spark, str(SMALL)))
