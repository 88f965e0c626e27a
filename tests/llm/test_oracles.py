"""Queries that SQL can express, against their SQL on the sf0.01 tables."""

import duckdb
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS FROM '{SF_DIR}/{t}.parquet'")
    relation = duck.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    expected = relation.fetchall()
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(names)
    order = sorted(names)
    rows = sorted(tuple(str(r[c]) for c in order) for r in result.collect())
    wanted = sorted(tuple(str(r[names.index(c)]) for c in order) for r in expected)
    assert rows and rows == wanted
