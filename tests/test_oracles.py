"""Every registered query against its SQL answer."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry
from marketflow.plans.oracles import ORACLES
from marketflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("events", "lineitem", "orders", "part")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    order = sorted(names)
    answer = Counter(
        tuple(row[names.index(c)] for c in order) for row in expected.fetchall()
    )
    got = Counter(tuple(row[c] for c in order) for row in result.collect())
    assert sum(got.values()) == sum(answer.values()) > 0
    assert not (got - answer) and not (answer - got), (
        f"columns {order}\nonly Spark: {list((got - answer))[:3]}\nonly SQL: {list((answer - got))[:3]}"
    )


def test_entry(spark):
    assert registry.entry(spark).count() > 0
