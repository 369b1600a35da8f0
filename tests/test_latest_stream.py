"""Keep-latest as a streaming aggregation."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marketflow.plans.batch import raw_to_rows
from marketflow.operators.latest import VERSION, latest_klines
from marketflow.sources import FileTopics
from marketflow.streaming import read_latest, start_latest
from marketflow.streaming.latest import write_updates
from test_messages import T0
from test_tables import DAY, kline

START = T0 - T0 % DAY


class Feed:
    """A raw candlestick topic in files, one a call."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset = spark, root, 0
        self.topics = FileTopics(f"{root}/raw", per_topic=True, files_per_trigger=1)
        self.messages: list = []

    def add(self, *messages) -> None:
        rows = [("kline_raw", None, 0, self.offset + n, json.dumps(m), None) for n, m in enumerate(messages)]
        self.offset += len(rows)
        self.messages += [(r[4], 0, r[3]) for r in rows]
        schema = "topic string, key string, `partition` int, `offset` bigint, value string, timestamp timestamp"
        frame = self.spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").partitionBy("topic").parquet(self.topics.sink_folder("kline_raw"))

    def run(self, **options):
        query = start_latest(self.spark, self.topics, f"{self.root}/latest", f"{self.root}/checkpoint", **options)
        query.awaitTermination()
        return query

    def rows(self, **options):
        return sorted(tuple(r) for r in read_latest(self.spark, f"{self.root}/latest", **options).collect())

    def want(self):
        raw = self.spark.createDataFrame(self.messages, "value string, `partition` int, `offset` bigint")
        return sorted(tuple(r) for r in latest_klines(raw_to_rows(raw, "kline", *VERSION)).drop(*VERSION).collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_state_gives_the_last_update_over_batches_and_restarts(feed):
    feed.add(kline("A", START, START + 10, 1), kline("A", START, START + 30, 2), kline("B", START, START + 5, 3))
    feed.run()
    assert feed.rows() == feed.want()
    # An older update, one of the same millisecond, one that no row can be made of, another day.
    broken = kline("C", START, START + 1, 9)
    broken["k"]["o"] = "x"
    feed.add(kline("A", START, START + 20, 4), kline("B", START, START + 5, 5), broken)
    feed.add(kline("A", START + DAY, START + DAY, 6))
    feed.run()
    assert feed.rows() == feed.want() and [r[0] for r in feed.rows()].count(4) == 0
    assert len(feed.rows(start="2023-11-15")) == 1 and len(feed.rows(end="2023-11-15")) == 2


def test_a_repeated_batch_changes_nothing(spark, feed):
    feed.add(kline("A", START, START + 10, 1))
    feed.run()
    before = feed.rows()
    other = feed.want() and spark.read.parquet(f"{feed.root}/latest/batch=0").drop("open_date")
    write_updates(other.withColumn("first_trade_id", F.lit(99).cast("long")), 0, f"{feed.root}/latest")
    assert feed.rows() == before
    write_updates(other.withColumn("event_ms", F.col("event_ms") + 1), 1, f"{feed.root}/latest")
    assert len(feed.rows()) == 1


def test_a_batch_that_broke_off_is_written_anew(spark, feed):
    feed.add(kline("A", START, START + 10, 1))
    # Files of an attempt that never ended.
    spark.range(3).write.parquet(f"{feed.root}/latest/batch=0/_temporary/0")
    feed.run()
    assert feed.rows() == feed.want()


def kept(query) -> list[int]:
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_a_watermark_lets_go_of_state(feed):
    for day in range(6):
        feed.add(*(kline(f"S{n}", START + day * DAY, START + day * DAY + 5, 10 * day + n) for n in range(4)))
    query = feed.run(watermark="1 day")
    assert max(kept(query)) <= 12 and kept(query)[-1] <= 8
    assert feed.rows() == feed.want()
    # Behind the watermark an update is dropped and counted; the table keeps what it had.
    before = feed.rows()
    feed.add(kline("S0", START, START + 900, 999))
    query = feed.run(watermark="1 day")
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    assert dropped == 1 and feed.rows() == before


def test_without_a_watermark_state_is_kept_and_late_updates_count(feed):
    for day in range(4):
        feed.add(kline("A", START + day * DAY, START + day * DAY, day))
    assert max(kept(feed.run())) == 4
    feed.add(kline("A", START, START + 900, 77))
    feed.run()
    assert feed.rows() == feed.want() and 77 in [r[0] for r in feed.rows()]
