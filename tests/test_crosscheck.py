"""Every query against its SQL on the sf0.01 tables: names, types, rows and values."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import TESTDATA
from crosscheck.oracles import ORACLES
from crosscheck.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.01"
TABLES = ["nation", "customer", "supplier", "orders", "lineitem", "events"]
# Spark type name -> DuckDB type name
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = duck.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    expected_rows = relation.fetchall()
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    expected_types = {r[0]: r[1] for r in described}

    assert sorted(result.columns) == sorted(names)
    for column, kind in result.dtypes:
        wanted = kind.upper() if kind.startswith("decimal") else TYPES[kind]
        assert expected_types[column].replace(" ", "") == wanted, column

    order = sorted(names)
    rows = sorted(tuple(str(r[c]) for c in order) for r in result.collect())
    position = [names.index(c) for c in order]
    expected = sorted(tuple(str(r[p]) for p in position) for r in expected_rows)
    assert rows, "an empty result checks nothing"
    assert len(rows) == len(expected)
    assert rows == expected
