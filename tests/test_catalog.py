"""Every query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
MODELS = [name for name in QUERIES if name.startswith("clf_")]


@pytest.fixture(scope="module")
def tables(sf):
    connection = duckdb.connect()
    for file in os.listdir(sf):
        name, extension = os.path.splitext(file)
        if extension == ".parquet":
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{file}'")
    return connection


def _plain(value):
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sf, tables, name):
    df = QUERIES[name](spark, sf)
    cursor = tables.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(tuple(map(_plain, row)) for row in cursor.fetchall())
    found = sorted(tuple(map(_plain, row)) for row in df.select(*columns).collect())
    assert found == expected and expected


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES and name not in MODELS])
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_ranks_the_label_first(spark):
    rows = contract.entry(spark).collect()
    assert rows[0].attribute == "large" and rows[0].gain_ratio == 1.0


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()
