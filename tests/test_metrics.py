"""Counts that loads report by themselves."""

from __future__ import annotations

import json
import time

from marketflow.sources import FileTopics, read_table
from marketflow.streaming import MetricsListener, metrics_of, start_direct
from test_messages import T0, TRADE


def test_every_micro_batch_reports_what_it_stored(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "raw"), per_topic=True, files_per_trigger=1)
    schema = "topic string, key string, `partition` int, `offset` bigint, value string, timestamp timestamp"
    for n, messages in enumerate(([TRADE, {**TRADE, "E": T0 + 5}], [{**TRADE, "p": None, "t": -1}, {**TRADE, "s": None, "p": None}])):
        rows = [("trade_raw", None, 0, 10 * n + i, json.dumps(m), None) for i, m in enumerate(messages)]
        folder = topics.sink_folder("trade_raw")
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").partitionBy("topic").parquet(folder)
        time.sleep(0.1)
    heard = []
    listener = MetricsListener(lambda name, counts: heard.append(counts))
    spark.streams.addListener(listener)
    try:
        query = start_direct(spark, "trade", topics, str(tmp_path / "trades"), str(tmp_path / "c"), metrics=True)
        query.awaitTermination()
        want = [
            {"batch": 0, "rows": 2, "rejected": 0, "newest_event_ms": T0 + 5, "faults": {}},
            {"batch": 1, "rows": 2, "rejected": 2, "newest_event_ms": T0, "faults": {"missing price": 2, "missing symbol": 1, "negative trade_id": 1}},
        ]
        assert metrics_of(query) == want
        for _ in range(100):
            if len(heard) >= 2:
                break
            time.sleep(0.1)
        assert heard == want
    finally:
        spark.streams.removeListener(listener)
    assert read_table(spark, "trade", str(tmp_path / "trades")).count() == 2


def test_loads_that_were_not_asked_report_nothing(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "raw"), per_topic=True)
    row = [("trade_raw", None, 0, 1, json.dumps(TRADE), None)]
    schema = "topic string, key string, `partition` int, `offset` bigint, value string, timestamp timestamp"
    spark.createDataFrame(row, schema).write.partitionBy("topic").parquet(topics.sink_folder("trade_raw"))
    query = start_direct(spark, "trade", topics, str(tmp_path / "trades"), str(tmp_path / "c"))
    query.awaitTermination()
    assert metrics_of(query) == []
