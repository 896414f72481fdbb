"""Every registered query against DuckDB on the same tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tests.conftest import DATA

QUERIES = spark_entry.catalog.QUERIES  # the optional ones have tests of their own
ORACLES = spark_entry.catalog.ORACLES


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


TYPES = {
    "string": "VARCHAR",
    "date": "DATE",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name, sf):
    sf_dir = f"{DATA}/{sf}"
    frame = QUERIES[name](spark, sf_dir)
    expected = connect(sf_dir).sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    columns = sorted(frame.columns)
    got = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    wanted = Counter(expected.select(*columns).fetchall())
    assert got == wanted
    assert sum(got.values()) > 0


def test_every_query_has_its_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


def test_roles_can_tell_right_from_wrong(spark):
    """Each status occurs, averages lack utilization, days lack interruptions."""
    sf_dir = f"{DATA}/sf0.01"
    found = QUERIES["request_status"](spark, sf_dir).groupBy("status").count().collect()
    assert len(found) == 4
    averages = QUERIES["daily_sensor_average"](spark, sf_dir).count()
    assert QUERIES["join_readings_utilization"](spark, sf_dir).count() < averages
    hot = QUERIES["request_features_hot"](spark, sf_dir).select("status").distinct().collect()
    assert len(hot) == 3
    assert QUERIES["union_readings"](spark, sf_dir).select("series").distinct().count() == 5


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.filter("maintenance = 'unscheduled maintenance'").count() == 23
    assert frame.count() == 206


GOLDEN = {
    "label_horizon_documented": (2091, 319),
    "label_horizon_as_coded": (2091, 907),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden_counts(spark, name):
    frame = QUERIES[name](spark, f"{DATA}/sf0.01")
    positive = frame.filter("maintenance = 'unscheduled maintenance'").count()
    assert (frame.count(), positive) == GOLDEN[name]


def test_golden_split(spark):
    sides = QUERIES["split_train_validation"](spark, f"{DATA}/sf0.01")
    assert sides.filter("side = 'training'").count() == 1464
