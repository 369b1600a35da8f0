"""Queries that SQL can express against their SQL, over whole tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from marketflow.llm.oracles import ORACLES
from marketflow.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    want = Counter(con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
    assert Counter(tuple(r) for r in result.select(columns).collect()) == want
