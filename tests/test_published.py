"""Published compactions, bucketed candlesticks, and micro-batches that wait for records."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from marketflow.operators.latest import VERSION
from marketflow.plans.batch import raw_to_rows
from marketflow.sources import (
    FileTopics,
    KafkaTopics,
    Rate,
    append_rows,
    create_bucketed_klines,
    insert_bucketed,
    publish_table,
    published_flush,
    published_rate,
    read_bucketed,
    read_published,
    replaced_dates,
)
from test_messages import T0, raw
from test_tables import DAY, kline, plan, stored_klines

DAYS = [T0 - T0 % DAY + n * DAY for n in range(4)]


def ids(frame) -> list[int]:
    return sorted(r.first_trade_id for r in frame.collect())


def test_readers_keep_what_they_opened(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "published")
    assert read_published(spark, "kline", target).collect() == []
    append_rows(stored_klines(spark, [kline("A", d, d, n) for n, d in enumerate(DAYS)]), "kline", log)
    since = publish_table(spark, "kline", log, target, overlap=dt.timedelta(0))
    opened = read_published(spark, "kline", target)
    time.sleep(0.1)
    append_rows(stored_klines(spark, [kline("A", DAYS[1], DAYS[1] + 9, 11), kline("B", DAYS[2], DAYS[2], 12)]), "kline", log)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "published").rglob("*.parquet")}
    publish_table(spark, "kline", log, target, since)
    assert ids(opened) == [0, 1, 2, 3]
    now = read_published(spark, "kline", target)
    assert ids(now) == [0, 2, 3, 11, 12] and ids(read_published(spark, "kline", target, version=1)) == [0, 1, 2, 3]
    assert before.items() <= {p: p.stat().st_mtime_ns for p in (tmp_path / "published").rglob("*.parquet")}.items()
    # Only the two dates with new files were rebuilt.
    assert sorted(p.name[-2:] for p in (tmp_path / "published" / "version=2").glob("open_date=*")) == ["15", "16"]
    assert sorted((r.version, r.open_date.day) for r in replaced_dates(spark, "kline", target).collect()) == [(1, 15), (1, 16)]
    some = read_published(spark, "kline", target, start="2023-11-15", end="2023-11-16")
    assert ids(some) == [11]
    filters = [line for line in plan(some).splitlines() if "PartitionFilters" in line]
    assert any("open_date" in f and "version" in f and "dynamicpruning" in f for f in filters)


def test_a_publication_that_broke_off_is_not_seen_and_written_anew(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "published")
    append_rows(stored_klines(spark, [kline("A", DAYS[0], DAYS[0], 1)]), "kline", log)
    publish_table(spark, "kline", log, target)
    # Data of a second version whose list of dates was never written.
    spark.read.parquet(f"{target}/version=1").withColumn("first_trade_id", F.lit(5).cast("long")).write.partitionBy("open_date").parquet(f"{target}/version=2")
    assert ids(read_published(spark, "kline", target)) == [1]
    append_rows(stored_klines(spark, [kline("B", DAYS[1], DAYS[1], 2)]), "kline", log)
    publish_table(spark, "kline", log, target)
    assert ids(read_published(spark, "kline", target)) == [1, 2]
    # Nothing new: nothing published.
    publish_table(spark, "kline", log, target, since="2100-01-01T00:00:00")
    assert not (tmp_path / "published" / "version=3").exists()


def test_keep_latest_of_a_bucketed_table_shuffles_nothing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE buckets_test LOCATION '{tmp_path / 'db'}'")
    try:
        table = "buckets_test.klines"
        create_bucketed_klines(spark, table, 4)
        create_bucketed_klines(spark, table, 4)
        assert read_bucketed(spark, table).collect() == []
        updates = [kline("HOT", DAYS[0], DAYS[0] + n, n) for n in range(50)] + [kline(f"S{n}", DAYS[n % 3], DAYS[n % 3], 100 + n) for n in range(9)]
        insert_bucketed(raw_to_rows(raw(spark, *updates).repartition(5), "kline", *VERSION), table)
        # One row of the busy candlestick, one file per bucket and date.
        assert spark.table(table).count() == 10
        files = list((tmp_path / "db").rglob("*.parquet"))
        assert len({(f.parent, f.name.split("_")[-1]) for f in files}) == len(files) <= 12
        insert_bucketed(raw_to_rows(raw(spark, kline("HOT", DAYS[0], DAYS[0] + 7, 77), kline("S0", DAYS[0], DAYS[0] + 7, 78)), "kline", *VERSION), table)
        latest = read_bucketed(spark, table)
        assert "Exchange" not in plan(latest) and "Bucketed: true" in plan(latest)
        assert ids(latest) == [49, 78, *range(101, 109)]
        assert ids(read_bucketed(spark, table, start="2023-11-15", end="2023-11-16")) == [101, 104, 107]
        with pytest.raises(ValueError):
            spark.sql("CREATE TABLE buckets_test.other (a int) USING parquet")
            insert_bucketed(raw_to_rows(raw(spark, updates[0]), "kline", *VERSION), "buckets_test.other")
    finally:
        spark.sql("DROP DATABASE buckets_test CASCADE")


def test_micro_batches_wait_for_records_or_time():
    rate = published_flush("trade")
    assert (rate.least, rate.delay, rate.records) == (1000, "500 milliseconds", None)
    assert published_flush("kline_3m").least == 10 and published_rate("trade").least is None
    options = KafkaTopics("b").source_options("t", rate.records, rate.least, rate.delay)
    assert options["minOffsetsPerTrigger"] == "1000" and options["maxTriggerDelay"] == "500 milliseconds"
    assert "maxOffsetsPerTrigger" not in options and "minOffsetsPerTrigger" not in KafkaTopics("b").source_options("t", 5)
    for half in ({"least": 5}, {"delay": "1 second"}):
        with pytest.raises(ValueError):
            Rate(**half)
    with pytest.raises(ValueError):
        FileTopics("/x").read_stream(None, "t", least=5, delay="1 second")
