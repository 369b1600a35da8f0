"""Point lookups through a summary of files."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from marketflow import normalize
from marketflow.plans.batch import STORED
from marketflow.sources import append_rows, lookup_rows, summarize_files
from test_messages import T0, TRADE, raw
from test_tables import DAY, kline, plan, stored_klines

NOW = dt.timedelta(0)


def trades(spark, numbers, symbol="A"):
    messages = [{**TRADE, "s": symbol, "t": n, "E": T0 + n * 1000} for n in numbers]
    return normalize(raw(spark, *messages), "trade", carry=STORED).coalesce(1)


def found(rows) -> list[int]:
    return sorted(r.trade_id for r in rows.collect())


@pytest.fixture
def table(spark, tmp_path):
    """Five batches of ten trades of A; the odd ones with trades of B as well."""
    path = str(tmp_path / "trades")
    for n in range(5):
        rows = trades(spark, range(n * 10, n * 10 + 10))
        append_rows(rows.unionByName(trades(spark, range(500, 510), "B")) if n % 2 else rows, "trade", path)
    time.sleep(0.05)
    return path, str(tmp_path / "summary")


def test_a_lookup_opens_the_files_that_may_hold_its_rows(spark, table):
    path, summary = table
    before = lookup_rows(spark, "trade", path, summary, "A", 17)
    assert found(before) == [17]
    every = len(before.inputFiles())
    summarize_files(spark, "trade", path, summary, overlap=NOW)
    one = lookup_rows(spark, "trade", path, summary, "A", 17)
    assert found(one) == [17] and len(one.inputFiles()) == 1 < every
    assert "PushedFilters" in plan(one) and "EqualTo(symbol,A)" in plan(one)
    assert found(lookup_rows(spark, "trade", path, summary, "A", 18, 21)) == [18, 19, 20, 21]
    both = lookup_rows(spark, "trade", path, summary, "B", 505)
    assert found(both) == [505, 505] and len(both.inputFiles()) == 2
    nothing = lookup_rows(spark, "trade", path, summary, "C", 17)
    assert found(nothing) == [] and nothing.inputFiles() == []


def test_rows_that_came_after_the_summary_are_found(spark, table):
    path, summary = table
    summarize_files(spark, "trade", path, summary, overlap=NOW)
    time.sleep(0.05)
    append_rows(trades(spark, [12, 90]), "trade", path)
    assert found(lookup_rows(spark, "trade", path, summary, "A", 12)) == [12, 12]
    assert found(lookup_rows(spark, "trade", path, summary, "A", 90)) == [90]
    time.sleep(0.05)
    for _ in range(2):
        summarize_files(spark, "trade", path, summary, overlap=NOW)
    later = lookup_rows(spark, "trade", path, summary, "A", 12)
    assert found(later) == [12, 12] and len(later.inputFiles()) == 2


def test_files_within_the_overlap_are_read_but_not_summarised(spark, table):
    path, summary = table
    summarize_files(spark, "trade", path, summary)
    assert found(lookup_rows(spark, "trade", path, summary, "A", 8, 11)) == [8, 9, 10, 11]


def test_more_files_than_may_be_named_are_scanned(spark, table):
    path, summary = table
    summarize_files(spark, "trade", path, summary, overlap=NOW)
    assert found(lookup_rows(spark, "trade", path, summary, "A", 0, 49, most_named=2)) == list(range(50))
    assert found(lookup_rows(spark, "trade", path, summary, "A", 0, 49, most_named=5)) == list(range(50))


def test_a_candlestick_is_found_by_its_opening_second(spark, tmp_path):
    path, summary = str(tmp_path / "klines"), str(tmp_path / "summary")
    opened = T0 - T0 % DAY
    for n in range(3):
        updates = [kline("A", opened + n * 60_000, opened + n, n), kline("A", opened, opened + 100 + n, 100 + n)]
        append_rows(stored_klines(spark, updates).coalesce(1), "kline", path)
    time.sleep(0.05)
    summarize_files(spark, "kline", path, summary, overlap=NOW)
    (row,) = lookup_rows(spark, "kline", path, summary, "A", opened // 1000).collect()
    assert row.first_trade_id == 102
    two = lookup_rows(spark, "kline", path, summary, "A", opened // 1000 + 60, opened // 1000 + 120)
    assert sorted(r.first_trade_id for r in two.collect()) == [1, 2]
