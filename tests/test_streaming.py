"""Streaming jobs over file topics."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketflow import Subscriptions, latest_klines, normalize
from marketflow.operators.latest import VERSION
from marketflow.plans.batch import backfill, raw_to_rows
from marketflow.sources import FileTopics, KafkaTopics, Rate, published_rate, read_quarantine, read_table
from marketflow.streaming import Pipeline, await_any, start_direct, start_routing, supervise
from marketflow.streaming.jobs import _start
from test_messages import ALL, DEPTH, KLINE, T0, TRADE

SCHEMA = "value string, offset bigint"


class Feed:
    """A folder of messages that tests add files to."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, str(path), 0

    def send(self, *messages):
        rows = [(m if isinstance(m, str) else json.dumps(m), self.sent + i) for i, m in enumerate(messages)]
        self.sent += len(rows)
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def pipeline_of(spark, tmp_path, endpoints, **options):
    return Pipeline(
        spark, endpoints, str(tmp_path), FileTopics(str(tmp_path / "raw")),
        FileTopics(str(tmp_path / "processed"), per_topic=True), **options,
    )


def finish(queries):
    for query in queries:
        query.awaitTermination()


def test_all_kinds_reach_their_tables(spark, tmp_path, feed):
    feed.send(*ALL.values(), "junk", {**TRADE, "p": "x", "t": 77}, '{"result":null,"id":1}')
    pipeline = pipeline_of(spark, tmp_path, list(ALL))
    pipeline.drain(feed.stream())
    for name, message in ALL.items():
        table = read_table(spark, name, pipeline.table_path(name))
        expected = raw_to_rows(
            spark.createDataFrame([(json.dumps(message),)], "value string"), name
        )
        assert table.exceptAll(expected).count() == expected.exceptAll(table).count() == 0
    (bad,) = read_quarantine(spark, "trade", pipeline.table_path("trade")).collect()
    assert bad.reject_reason == "missing price"
    assert json.loads(bad.value)["trade_id"] == 77


def test_restart_neither_repeats_nor_loses(spark, tmp_path, feed):
    pipeline = pipeline_of(spark, tmp_path, ["trade"])
    feed.send(*({**TRADE, "t": i} for i in range(10)))
    pipeline.drain(feed.stream())
    pipeline.drain(feed.stream())
    feed.send(*({**TRADE, "t": i} for i in range(10, 15)))
    pipeline.drain(feed.stream())
    ids = [r.trade_id for r in read_table(spark, "trade", pipeline.table_path("trade")).collect()]
    assert sorted(ids) == list(range(15))


def test_direct_batch_and_staged_paths_agree(spark, tmp_path, feed):
    opened = T0 - T0 % 60_000
    for batch in range(3):
        feed.send(
            *(
                {**KLINE, "s": f"S{i % 4}", "E": T0 + 137 * i, "k": {**KLINE["k"], "t": opened, "f": 10 * i + batch}}
                for i in range(20)
            )
        )
    staged = pipeline_of(spark, tmp_path, ["kline_3m", "kline_5m"])
    staged.drain(feed.stream())
    direct = Pipeline(spark, ["kline"], str(tmp_path / "direct"), staged.raw, staged.processed)
    finish(direct.direct())
    backfill(spark, "kline", staged.raw, str(tmp_path / "batch"))
    raw = staged.raw.read(spark, "kline_raw")
    expected = latest_klines(raw_to_rows(raw, "kline", *VERSION)).drop(*VERSION).collect()
    assert len(expected) == 4
    for path in (staged.table_path("kline"), direct.table_path("kline"), str(tmp_path / "batch")):
        assert sorted(read_table(spark, "kline", path).collect()) == sorted(expected)
        assert read_table(spark, "kline", path, all_updates=True).count() == 60


def test_one_file_per_batch_gives_the_same_rows(spark, tmp_path, feed):
    for i in range(4):
        feed.send(*({**TRADE, "t": 10 * i + j} for j in range(3)))
    topics = FileTopics(str(tmp_path / "raw"), files_per_trigger=1)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed.path)
    query = start_routing(stream, topics, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    pipeline = Pipeline(spark, ["trade"], str(tmp_path), topics, topics)
    (direct,) = pipeline.direct()
    direct.awaitTermination()
    assert len([p for p in direct.recentProgress if p["numInputRows"]]) == 4
    ids = [r.trade_id for r in read_table(spark, "trade", pipeline.table_path("trade")).collect()]
    assert sorted(ids) == sorted(10 * i + j for i in range(4) for j in range(3))


def test_tasks_share_a_large_file_of_a_topic(spark, tmp_path):
    many = spark.range(0, 120_000, 1, 1).select(
        F.lit("trade_raw").alias("topic"), F.lit(0).alias("partition"), F.sha2(F.col("id").cast("string"), 256).alias("value"), F.col("id").alias("offset")
    )
    many.write.parquet(str(tmp_path / "feed"))
    topics, root = FileTopics(str(tmp_path / "raw")), str(tmp_path)
    stream = spark.readStream.schema(many.schema).parquet(f"{root}/feed")
    before = spark.conf.get("parquet.block.size", None)
    query = _start(spark, topics.writer(stream), topics.sink_folder(), f"{root}/checkpoint", "copy", False)
    query.awaitTermination()
    assert spark.conf.get("parquet.block.size", None) == before
    groups = [pq.ParquetFile(f).num_row_groups for f in (tmp_path / "raw").rglob("*.parquet")]
    assert sum(groups) > 2 * len(groups)
    assert sorted(r.offset for r in topics.read(spark, "trade_raw").select("offset").collect()) == list(range(120_000))


def test_dead_letters_and_subscriptions(spark, tmp_path, feed):
    feed.send(TRADE, DEPTH, {**TRADE, "s": "OTHER"}, "junk")
    topics = FileTopics(str(tmp_path / "all"))
    start_routing(feed.stream(), topics, str(tmp_path / "c1"), dead_letter_topic="rejected").awaitTermination()
    assert [(r.value, r.key) for r in topics.read(spark, "rejected").collect()] == [("junk", "malformed")]
    assert topics.read(spark, "trade_raw").count() == 2
    some = FileTopics(str(tmp_path / "some"))
    wanted = Subscriptions.of(["btcusdt"], ["trade"])
    start_routing(feed.stream(), some, str(tmp_path / "c2"), subscriptions=wanted).awaitTermination()
    assert some.read(spark, "trade_raw").count() == 1
    assert some.read(spark, "depth_raw").count() == 0
    assert [r.value for r in some.read(spark, "dead_letters").collect()] == ["junk"]
    none = FileTopics(str(tmp_path / "none"))
    start_routing(feed.stream(), none, str(tmp_path / "c3"), dead_letter_topic=None).awaitTermination()
    assert {r.topic for r in spark.read.parquet(none.path).collect()} == {"trade_raw", "depth_raw"}


def test_of_a_repeated_key_the_last_value_reaches_the_table(spark, tmp_path, feed):
    twice = json.dumps({**TRADE, "t": 5})[:-1] + f', "t": 6, "E": {T0 + 1000}}}'
    feed.send(twice, '{"e":"trade","e":"trade"}', {"result": None, "id": 1}, {"e": "bookTicker", "E": 1}, {"e": "trade"})
    pipeline = pipeline_of(spark, tmp_path, ["trade"])
    pipeline.drain(feed.stream())
    lost = {r.offset: r.key for r in pipeline.raw.read(spark, "dead_letters").collect()}
    assert lost == {1: "no event time", 4: "no event time"}
    assert [r.value for r in pipeline.raw.read(spark, "trade_raw").collect()] == [twice]
    (row,) = read_table(spark, "trade", pipeline.table_path("trade")).collect()
    assert row.trade_id == 6 and row.timestamp_utc.timestamp() == (T0 + 1000) // 1000


def test_a_failed_kind_is_started_again_and_leaves_the_others_alone(spark, tmp_path, feed):
    feed.send(*({**TRADE, "t": i} for i in range(20)), DEPTH)
    pipeline = pipeline_of(spark, tmp_path, ["trade", "depth"])
    pipeline.route(feed.stream()).awaitTermination()
    block = tmp_path / "tables" / "trades" / "rejected=false"
    block.parent.mkdir(parents=True)
    block.write_text("in the way")
    heard, started = [], []

    def on_failure(name, error):
        heard.append(name)
        if len(heard) == 2:
            block.unlink()

    starts = {
        name: lambda name=name, start=start: started.append(name) or start()
        for name, start in pipeline.starts("direct").items()
    }
    outcomes = supervise(starts, pause=0.1, poll=0.1, on_failure=on_failure)
    assert heard == ["trade", "trade"] and sorted(started) == ["depth", "trade", "trade", "trade"]
    assert (outcomes["trade"].restarts, outcomes["trade"].error) == (2, None) and outcomes["depth"].restarts == 0
    ids = [r.trade_id for r in read_table(spark, "trade", pipeline.table_path("trade")).collect()]
    assert sorted(ids) == list(range(20)) and read_table(spark, "depth", pipeline.table_path("depth")).count() == 1
    spark.streams.resetTerminated()


def test_a_kind_is_given_up_after_its_last_restart(spark, tmp_path, feed):
    feed.send(TRADE, DEPTH)
    pipeline = pipeline_of(spark, tmp_path, ["trade", "depth"])
    pipeline.route(feed.stream()).awaitTermination()
    # The folder is another's, so the job cannot even be started.
    start_direct(spark, "trade", pipeline.raw, pipeline.table_path("trade"), str(tmp_path / "other")).awaitTermination()
    outcomes = pipeline.supervise("direct", restarts=1, pause=0.1, poll=0.1)
    assert outcomes["direct-trade"].restarts == 1 and "belongs to" in str(outcomes["direct-trade"].error)
    assert outcomes["direct-depth"].error is None
    assert read_table(spark, "depth", pipeline.table_path("depth")).count() == 1


def test_a_pipeline_routes_its_own_kinds_and_markets(spark, tmp_path, feed):
    feed.send(TRADE, DEPTH, KLINE, {**KLINE, "k": {**KLINE["k"], "i": "5m"}}, {**KLINE, "s": "OTHER"})
    pipeline = pipeline_of(spark, tmp_path, ["kline_3m"], markets=["btcusdt"])
    pipeline.route(feed.stream()).awaitTermination()
    assert [(r.topic, r.offset) for r in spark.read.parquet(pipeline.raw.path).collect()] == [("kline_raw", 2)]


def test_two_pipelines_run_in_one_session(spark, tmp_path, feed):
    feed.send(TRADE)
    queries = []
    for name in ("a", "b"):
        root = tmp_path / name
        start_routing(feed.stream(), FileTopics(str(root / "raw")), str(root / "c")).awaitTermination()
        queries += pipeline_of(spark, root, ["trade"], live=True).direct()
    for query in queries:
        query.processAllAvailable()
        query.stop()
    assert len({q.name for q in queries}) == 2


def test_a_failed_write_loses_no_row(spark, tmp_path, feed):
    feed.send(*({**TRADE, "t": i} for i in range(20)))
    pipeline = pipeline_of(spark, tmp_path, ["trade"])
    pipeline.route(feed.stream()).awaitTermination()
    block = tmp_path / "tables" / "trades" / "rejected=false"
    block.parent.mkdir(parents=True)
    block.write_text("in the way")
    with pytest.raises(StreamingQueryException):
        finish(pipeline.direct())
    spark.streams.resetTerminated()
    block.unlink()
    finish(pipeline.direct())
    ids = [r.trade_id for r in read_table(spark, "trade", pipeline.table_path("trade")).collect()]
    assert sorted(ids) == list(range(20))


def test_backfills_may_run_again(spark, tmp_path, feed):
    feed.send(*({**TRADE, "t": i} for i in range(30)))
    topics, path = FileTopics(str(tmp_path / "raw")), str(tmp_path / "trades")
    start_routing(feed.stream(), topics, str(tmp_path / "c")).awaitTermination()
    backfill(spark, "trade", topics, path, start=5, end=10)
    assert sorted(r.trade_id for r in read_table(spark, "trade", path).collect()) == list(range(5, 10))
    for _ in range(2):
        backfill(spark, "trade", topics, path)
    assert sorted(r.trade_id for r in read_table(spark, "trade", path).collect()) == list(range(30))


def test_live_jobs_run_until_stopped(spark, tmp_path, feed):
    feed.send({**TRADE, "t": 1})
    start_routing(feed.stream(), FileTopics(str(tmp_path / "raw")), str(tmp_path / "c")).awaitTermination()
    pipeline = pipeline_of(spark, tmp_path, ["trade"], live=True, rates={"trade": Rate(None, "100 milliseconds")})
    (query,) = pipeline.direct()
    query.processAllAvailable()
    assert query.isActive and query.name.startswith("direct-trade ")
    query.stop()
    await_any(spark)
    assert read_table(spark, "trade", pipeline.table_path("trade")).count() == 1


def test_streams_hold_no_shuffle(spark, tmp_path, feed):
    feed.send(TRADE)
    topics = FileTopics(str(tmp_path / "raw"))
    start_routing(feed.stream(), topics, str(tmp_path / "c")).awaitTermination()
    (query,) = Pipeline(spark, ["trade"], str(tmp_path), topics, topics).direct()
    query.awaitTermination()
    assert "Exchange" not in query._jsq.explainInternal(False)


def test_a_shared_folder_takes_no_single_topic(spark, tmp_path, feed):
    feed.send(TRADE)
    pipeline = Pipeline(spark, ["trade"], str(tmp_path), FileTopics(str(tmp_path)), FileTopics(str(tmp_path)))
    with pytest.raises(ValueError):
        pipeline.transform()
    with pytest.raises(ValueError):
        start_routing(feed.stream(), FileTopics(str(tmp_path), per_topic=True), str(tmp_path / "c"))


def test_batches_and_streams_do_not_share_a_folder(spark, tmp_path, feed):
    feed.send(TRADE)
    topics = FileTopics(str(tmp_path / "raw"))
    start_routing(feed.stream(), topics, str(tmp_path / "c")).awaitTermination()
    pipeline = Pipeline(spark, ["trade"], str(tmp_path), topics, topics)
    finish(pipeline.direct())
    with pytest.raises(ValueError):
        backfill(spark, "trade", topics, pipeline.table_path("trade"))
    backfill(spark, "trade", topics, str(tmp_path / "b" / "tables" / "trades"))
    with pytest.raises(ValueError):
        Pipeline(spark, ["trade"], str(tmp_path / "b"), topics, topics).direct()
    finish(pipeline.direct())
    assert read_table(spark, "trade", pipeline.table_path("trade")).count() == 1
    with pytest.raises(ValueError):
        start_direct(spark, "trade", topics, pipeline.table_path("trade"), str(tmp_path / "other"))
    with pytest.raises(ValueError):
        start_routing(feed.stream(), topics, str(tmp_path / "other"))


def test_rates(spark, tmp_path):
    with pytest.raises(ValueError):
        pipeline_of(spark, tmp_path, ["trade"], rates={"trade": Rate(5)}).direct()
    assert published_rate("trade") == published_rate("aggTrade") == Rate(1000, "500 milliseconds")
    for name in ("kline_3m", "avgPrice", "miniTicker", "ticker", "depth"):
        assert published_rate(name) == Rate(10, "1 second")


def test_kafka_options():
    topics = KafkaTopics("broker:9092", options={"kafka.security.protocol": "SSL"})
    assert topics.source_options("trade_raw", 1000) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "trade_raw",
        "startingOffsets": "earliest",
        "minPartitions": "9",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "1000",
        "kafka.security.protocol": "SSL",
    }
    assert "maxOffsetsPerTrigger" not in topics.source_options("trade_raw")
    assert KafkaTopics("b", allow_data_loss=True).source_options("t")["failOnDataLoss"] == "false"
    some = KafkaTopics("b", partitions=2).range_options("t", 5, 9)
    assert some["startingOffsets"] == '{"t": {"0": 5, "1": 5}}' and some["endingOffsets"] == '{"t": {"0": 9, "1": 9}}'
    assert KafkaTopics("b").range_options("t")["startingOffsets"] == "earliest"


def test_kafka_sink_takes_topic_partition_and_value(spark, feed):
    feed.send(TRADE)
    records = normalize(feed.stream(), "trade", carry=("offset",)).selectExpr(
        "'t' as topic", "1 as partition", "offset", "symbol as value"
    )
    assert KafkaTopics("broker:9092").writer(records) is not None
