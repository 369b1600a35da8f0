"""The registered queries: operators over messages made from whole test tables.

Results are given in forms that compare alike everywhere: decimals as text, instants
as epoch seconds, order books as one row per level.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import base_endpoint
from marketflow.operators import (
    Subscriptions,
    decode_processed,
    encode_processed,
    filter_subscribed,
    latest_klines,
    normalize,
    quarantined_rows,
    rejected_messages,
    route_raw,
    routed_messages,
    subscription_pairs,
    valid_rows,
    validate,
)
from marketflow.operators.validate import REASON
from marketflow.plans import adapters
from marketflow.operators.latest import VERSION
from marketflow.plans.batch import STORED, backfill, raw_to_rows
from marketflow.sources.tables import (
    append_rows,
    compact_table,
    create_tables,
    insert_rows,
    read_compacted,
    read_quarantine,
    read_table,
    stored_positions,
)
from marketflow.sources.bucketed import create_bucketed_klines, insert_bucketed, read_bucketed
from marketflow.sources.lookup import lookup_rows, summarize_files
from marketflow.sources.numbered import NumberedTopics
from marketflow.sources.published import publish_table, read_published
from marketflow.sources.topics import ROW_GROUP, ROW_GROUP_BYTES, FileTopics
from marketflow.sources.work import new_work_dir
from marketflow.streaming import Pipeline
from marketflow.streaming.jobs import DEAD_LETTERS, start_direct
from marketflow.streaming.metrics import metrics_of
from marketflow.streaming.latest import read_latest, start_latest

MARKETS = ["CLICK", "Purchase", ""]
ENDPOINTS = ["trade", "kline_3m", "kline_1h", "depth", ""]


def comparable(df: DataFrame) -> DataFrame:
    def column(field):
        if isinstance(field.dataType, T.DecimalType):
            return adapters.plain_text(F.col(field.name), field.dataType.scale).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_seconds(field.name).alias(field.name)
        return F.col(field.name)

    return df.select(*(column(f) for f in df.schema.fields))


def _rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return adapters.read_rows(spark, sf_dir, table)


def _stored_events(spark: SparkSession, sf_dir: str, root: str, files: int) -> None:
    """The events in a number of files, each of which many tasks can share."""
    parts = _rows(spark, sf_dir, "events").repartition(files)
    parts.write.option(ROW_GROUP, ROW_GROUP_BYTES).parquet(f"{root}/events.parquet")


def trades_normalized(spark, sf_dir):
    return comparable(raw_to_rows(adapters.trades(_rows(spark, sf_dir, "events")), "trade", "partition"))


def agg_trades_normalized(spark, sf_dir):
    return comparable(raw_to_rows(adapters.agg_trades(_rows(spark, sf_dir, "lineitem")), "aggTrade", "partition"))


def klines_normalized(spark, sf_dir):
    """Every candlestick update before the load stage: ids of empty bars are still -1."""
    return comparable(normalize(adapters.klines(_rows(spark, sf_dir, "events")), "kline_1h"))


def klines_latest(spark, sf_dir):
    updates = raw_to_rows(adapters.klines(_rows(spark, sf_dir, "events")), "kline", *VERSION)
    return comparable(latest_klines(updates).drop(*VERSION))


def klines_latest_partitioned(spark, sf_dir):
    """As ``klines_latest``; offsets rise within a topic partition and fall from one to the next."""
    raw = adapters.klines(_rows(spark, sf_dir, "events"))
    raw = raw.withColumn("offset", F.col("offset") + (9 - F.col("partition")) * 1_000_000_000_000)
    return comparable(latest_klines(raw_to_rows(raw, "kline", *VERSION)).drop(*VERSION))


def mini_tickers_normalized(spark, sf_dir):
    return comparable(raw_to_rows(adapters.mini_tickers(_rows(spark, sf_dir, "orders")), "miniTicker"))


def tickers_normalized(spark, sf_dir):
    return comparable(raw_to_rows(adapters.tickers(_rows(spark, sf_dir, "orders")), "ticker"))


def avg_prices_normalized(spark, sf_dir):
    return comparable(raw_to_rows(adapters.avg_prices(_rows(spark, sf_dir, "part")), "avgPrice"))


def depth_top5(spark, sf_dir):
    books = raw_to_rows(adapters.depths(_rows(spark, sf_dir, "events")), "depth")
    sides = F.array(
        F.struct(F.lit("bid").alias("side"), F.col("bids").alias("levels")),
        F.struct(F.lit("ask").alias("side"), F.col("asks").alias("levels")),
    )
    levels = books.select(
        "timestamp_utc", "symbol", "first_update_id", "final_update_id", F.inline(sides)
    ).select("*", F.posexplode("levels").alias("level", "pair"))
    return comparable(
        levels.select(
            "timestamp_utc",
            "symbol",
            "first_update_id",
            "final_update_id",
            "side",
            "level",
            F.get("pair", F.lit(0)).alias("price"),
            F.get("pair", F.lit(1)).alias("quantity"),
        )
    )


def routed_raw(spark, sf_dir):
    messages = adapters.disturbed_trades(_rows(spark, sf_dir, "events"))
    return routed_messages(route_raw(messages, rewrite_json=True, carry=("offset",)), carry=("offset",))


def route_rejects(spark, sf_dir):
    messages = adapters.disturbed_trades(_rows(spark, sf_dir, "events"))
    return rejected_messages(route_raw(messages, carry=("offset",))).select("offset", REASON)


def route_repeated_keys(spark, sf_dir):
    """Messages of three kinds, half of them with keys sent twice: where they go, or why nowhere."""
    routed = route_raw(adapters.repeated_keys(_rows(spark, sf_dir, "events")), carry=("offset",))
    named = {c: F.coalesce(c, F.lit("")).alias(c) for c in ("topic", "symbol", "interval", REASON)}
    return routed.select(*named.values(), F.coalesce("partition", F.lit(-1)).alias("partition"), "offset")


def trades_repeated_keys(spark, sf_dir):
    """Of the same messages the trades, routed and made table rows: the last value of each key counts."""
    routed = route_raw(adapters.repeated_keys(_rows(spark, sf_dir, "events")), rewrite_json=True)
    trades = routed_messages(routed).filter(F.col("topic") == "trade_raw")
    return comparable(raw_to_rows(trades, "trade"))


def subscription_filter(spark, sf_dir):
    routed = route_raw(adapters.mixed(_rows(spark, sf_dir, "events")), carry=("offset",))
    kept = filter_subscribed(routed, Subscriptions.of(MARKETS, ENDPOINTS))
    interval = F.coalesce("interval", F.lit("")).alias("interval")
    return kept.select("topic", "partition", "symbol", interval, "offset")


def subscription_pairs_listed(spark, sf_dir):
    markets = _rows(spark, sf_dir, "events").select(F.upper("event_type").alias("market")).distinct()
    return subscription_pairs(markets, ENDPOINTS)


def topics_of_endpoints(spark, sf_dir):
    """Raw topics of endpoint names, each once: candlestick intervals share a topic."""
    names = F.concat_ws("_", "event_type", F.concat(F.get_json_object("props", "$.k"), F.lit("m")))
    endpoints = _rows(spark, sf_dir, "events").select(base_endpoint(names).alias("endpoint"))
    return endpoints.distinct().select("endpoint", F.concat("endpoint", F.lit("_raw")).alias("topic"))


def valid_trades(spark, sf_dir):
    rows = normalize(adapters.faulty_trades(_rows(spark, sf_dir, "events")), "trade")
    return comparable(valid_rows(validate(rows, "trade"), "trade", "partition"))


def quarantine_reasons(spark, sf_dir):
    rows = normalize(adapters.faulty_trades(_rows(spark, sf_dir, "events")), "trade", carry=("offset",))
    return quarantined_rows(validate(rows, "trade")).select("offset", REASON)


def processed_encoded(spark, sf_dir):
    rows = normalize(adapters.trades(_rows(spark, sf_dir, "events")), "trade", carry=("partition", "offset"))
    return encode_processed(rows, "trade", carry=("offset",))


def processed_roundtrip(spark, sf_dir):
    rows = normalize(adapters.klines(_rows(spark, sf_dir, "events")), "kline", carry=("partition",))
    decoded = decode_processed(encode_processed(rows, "kline"), "kline", carry=("partition",))
    return comparable(valid_rows(validate(decoded, "kline"), "kline", "partition"))


def trades_table(spark, sf_dir):
    """Trades appended to a table folder and read back."""
    path = f"{new_work_dir(spark)}/trades"
    raw = adapters.trades(_rows(spark, sf_dir, "events"))
    append_rows(normalize(raw, "trade", carry=STORED), "trade", path)
    return comparable(read_table(spark, "trade", path))


def catalog_table(spark, sf_dir):
    """Average prices inserted into a catalog table that is created twice."""
    database = "marketflow_query"
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{new_work_dir(spark)}'")
    (name,) = create_tables(spark, ["avgPrice"], database)
    create_tables(spark, ["avgPrice"], database)
    rows = raw_to_rows(adapters.avg_prices(_rows(spark, sf_dir, "part")), "avgPrice")
    insert_rows(rows, "avgPrice", name)
    return comparable(spark.table(name).drop("event_date"))


def _compacted_klines(spark, sf_dir) -> tuple[str, str, str]:
    """A log of updates that is compacted before the last of them come, all on even days."""
    root = new_work_dir(spark)
    log, target = f"{root}/klines", f"{root}/klines_latest"
    updates = normalize(adapters.klines(_rows(spark, sf_dir, "events")), "kline", carry=STORED)
    late = (F.col("partition") >= 4) & (F.dayofmonth("open_timestamp_utc") % 2 == 0)
    append_rows(updates.filter(~late), "kline", log)
    since = compact_table(spark, "kline", log, target, overlap=dt.timedelta(0))
    append_rows(updates.filter(late), "kline", log)
    return log, target, since


def klines_compacted(spark, sf_dir):
    """Candlestick updates appended to a log in two batches, compacted in between."""
    return comparable(read_compacted(spark, "kline", *_compacted_klines(spark, sf_dir)))


def klines_recompacted(spark, sf_dir):
    """As ``klines_compacted``, read from the copy after a second, partial compaction."""
    log, target, since = _compacted_klines(spark, sf_dir)
    compact_table(spark, "kline", log, target, since)
    return comparable(spark.read.parquet(target).drop("open_date"))


def _drained(spark, sf_dir, endpoints, messages) -> Pipeline:
    root = new_work_dir(spark)
    raw, processed = FileTopics(f"{root}/raw"), FileTopics(f"{root}/processed", per_topic=True)
    pipeline = Pipeline(spark, endpoints, root, raw, processed)
    pipeline.drain(messages)
    return pipeline


def stream_trades(spark, sf_dir):
    """Disturbed trades through the streaming stages: route, transform, load."""
    messages = adapters.disturbed_trades(adapters.stream_rows(spark, sf_dir, "events"))
    pipeline = _drained(spark, sf_dir, ["trade"], messages)
    return comparable(read_table(spark, "trade", pipeline.table_path("trade")))


def stream_klines_latest(spark, sf_dir):
    """Candlesticks among other kinds through the streaming stages, reduced to the last update."""
    messages = adapters.mixed(adapters.stream_rows(spark, sf_dir, "events"))
    pipeline = _drained(spark, sf_dir, ["kline_1h", "kline_3m"], messages)
    return comparable(read_table(spark, "kline", pipeline.table_path("kline")))


def stream_quarantine(spark, sf_dir):
    """Faulty trades routed and loaded straight from the raw topic: what is quarantined."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["trade"], root, topics, topics)
    pipeline.route(adapters.faulty_trades(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    for query in pipeline.direct():
        query.awaitTermination()
    return read_quarantine(spark, "trade", pipeline.table_path("trade")).select("offset", REASON)


def stream_compacted(spark, sf_dir):
    """Average prices of a stream-written table, compacted by date."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["avgPrice"], root, topics, topics)
    pipeline.route(adapters.avg_prices(adapters.stream_rows(spark, sf_dir, "part"))).awaitTermination()
    for query in pipeline.direct():
        query.awaitTermination()
    compact_table(spark, "avgPrice", pipeline.table_path("avgPrice"), f"{root}/compacted")
    return comparable(spark.read.parquet(f"{root}/compacted").drop("event_date"))


def backfilled_depths(spark, sf_dir):
    """Books routed to a stored topic by a stream, then appended to a table in batch."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["depth"], root, topics, topics)
    pipeline.route(adapters.depths(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    backfill(spark, "depth", topics, pipeline.table_path("depth"))
    books = read_table(spark, "depth", pipeline.table_path("depth"))
    return comparable(
        books.select(
            "timestamp_utc",
            "symbol",
            "first_update_id",
            "final_update_id",
            F.size("bids").alias("bid_levels"),
            F.size("asks").alias("ask_levels"),
            F.get(F.get("bids", F.lit(0)), F.lit(0)).alias("best_bid"),
            F.get(F.get("asks", F.lit(0)), F.lit(0)).alias("best_ask"),
        )
    )


def stream_subscribed(spark, sf_dir):
    """Of several kinds and markets, one kind and market through the streaming stages."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["trade"], root, topics, topics, markets=["CLICK"])
    pipeline.route(adapters.mixed(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    return comparable(raw_to_rows(spark.read.schema(topics.SCHEMA).parquet(topics.path), "trade"))


def stream_dead_letters(spark, sf_dir):
    """Disturbed trades routed for one market: what should have had a topic, and why it has none."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["trade"], root, topics, topics, markets=["CLICK"])
    pipeline.route(adapters.disturbed_trades(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    lost = topics.read(spark, DEAD_LETTERS)
    return lost.select("offset", F.substring("value", 1, 8).alias("begins"), F.col("key").alias(REASON))


def stream_resumed(spark, sf_dir):
    """Trades drained, more of them arriving, and drained again from the same checkpoints."""
    root = new_work_dir(spark)
    events = _rows(spark, sf_dir, "events")
    pipeline = Pipeline(
        spark, ["trade"], root, FileTopics(f"{root}/raw"), FileTopics(f"{root}/processed", per_topic=True)
    )
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{root}/events.parquet")
        pipeline.drain(adapters.trades(adapters.stream_rows(spark, root, "events")))
    return comparable(read_table(spark, "trade", pipeline.table_path("trade")))


def stream_rate_limited(spark, sf_dir):
    """Two kinds at once, a file per micro-batch at every stage."""
    root = new_work_dir(spark)
    _stored_events(spark, sf_dir, root, 4)
    topics = FileTopics(f"{root}/raw", files_per_trigger=1)
    pipeline = Pipeline(spark, ["trade", "depth"], root, topics, topics)
    pipeline.route(adapters.mixed(adapters.stream_rows(spark, root, "events", 1))).awaitTermination()
    for query in pipeline.direct():
        query.awaitTermination()
    books = read_table(spark, "depth", pipeline.table_path("depth"))
    trades = read_table(spark, "trade", pipeline.table_path("trade"))
    return trades.select("symbol", F.col("trade_id").alias("id"), F.lit("trade").alias("kind")).unionByName(
        books.select("symbol", F.col("first_update_id").alias("id"), F.lit("depth").alias("kind"))
    )


def backfilled_twice(spark, sf_dir):
    """Half of a raw topic backfilled, then all of it, twice."""
    root = new_work_dir(spark)
    topics = FileTopics(f"{root}/raw")
    pipeline = Pipeline(spark, ["trade"], root, topics, topics)
    pipeline.route(adapters.trades(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    path = pipeline.table_path("trade")
    backfill(spark, "trade", topics, path, start=100, end=5000)
    for _ in range(2):
        backfill(spark, "trade", topics, path)
    return comparable(read_table(spark, "trade", path))


def backfilled_processed(spark, sf_dir):
    """Candlesticks backfilled from the processed topic, reduced to the last update."""
    root = new_work_dir(spark)
    processed = FileTopics(f"{root}/processed", per_topic=True)
    pipeline = Pipeline(spark, ["kline_1h"], root, FileTopics(f"{root}/raw"), processed)
    pipeline.route(adapters.klines(adapters.stream_rows(spark, sf_dir, "events"))).awaitTermination()
    for query in pipeline.transform():
        query.awaitTermination()
    backfill(spark, "kline", processed, pipeline.table_path("kline"), processed=True)
    return comparable(read_table(spark, "kline", pipeline.table_path("kline")))


def _numbered_trades(spark, sf_dir, root: str) -> NumberedTopics:
    """Trades routed to numbered topics in two batches, even event ids first, with the event time as theirs."""
    topics = NumberedTopics(f"{root}/raw")
    events = _rows(spark, sf_dir, "events")
    for half in (0, 1):
        routed = routed_messages(route_raw(adapters.trades(events.filter(F.col("event_id") % 2 == half))))
        time = F.timestamp_millis(F.get_json_object("value", "$.E").cast("bigint"))
        topics.append(routed.withColumn("timestamp", time))
    return topics


def topic_offsets(spark, sf_dir):
    """Offsets that two batches of trades get: consecutive per topic partition, the second after the first."""
    topics = _numbered_trades(spark, sf_dir, new_work_dir(spark))
    half = F.get_json_object("value", "$.t").cast("bigint") % 2
    return topics.read(spark, "trade_raw").select("topic", "partition", "offset", half.cast("int").alias("half"))


# Bounds of a backfill by time.
SINCE = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
UNTIL = dt.datetime(2024, 1, 3, tzinfo=dt.timezone.utc)


def _backfilled_gaps(spark, sf_dir) -> str:
    """A range of a topic, another one in every partition, then all of it, twice."""
    root = new_work_dir(spark)
    topics, path = _numbered_trades(spark, sf_dir, root), f"{root}/trades"
    backfill(spark, "trade", topics, path, start=10, end=60)
    ends = {p: 70 + 5 * p for p in range(9)}
    backfill(spark, "trade", topics, path, start={p: 50 + 5 * p for p in range(9)}, end=ends)
    for _ in range(2):
        backfill(spark, "trade", topics, path)
    return path


def backfilled_gaps(spark, sf_dir):
    """Trades of a topic backfilled range by range, with the gaps filled by what came last."""
    return comparable(read_table(spark, "trade", _backfilled_gaps(spark, sf_dir)))


def backfilled_positions(spark, sf_dir):
    """What the ledger of such a table lists: one interval of offsets per topic partition."""
    return stored_positions(spark, _backfilled_gaps(spark, sf_dir))


def backfilled_range(spark, sf_dir):
    """Trades of a file topic from the first one of a day on and before the first one of the next, by record time."""
    root = new_work_dir(spark)
    topics, path = NumberedTopics(f"{root}/raw"), f"{root}/trades"
    routed = routed_messages(route_raw(adapters.trades(_rows(spark, sf_dir, "events"))))
    time = F.timestamp_millis(F.get_json_object("value", "$.E").cast("bigint"))
    dated = routed.withColumn("timestamp", time)
    # Earlier records come in an earlier batch; within a batch they come in any order.
    part = (time >= F.lit(SINCE)).cast("int") + (time >= F.lit(UNTIL)).cast("int")
    for n in range(3):
        topics.append(dated.filter(part == n))
    backfill(spark, "trade", topics, path, since=SINCE, until=UNTIL)
    return comparable(read_table(spark, "trade", path))


def klines_published(spark, sf_dir):
    """As ``klines_recompacted``, published twice: dates of two versions, read through the list of dates."""
    root = new_work_dir(spark)
    log, target = f"{root}/klines", f"{root}/published"
    updates = normalize(adapters.klines(_rows(spark, sf_dir, "events")), "kline", carry=STORED)
    late = (F.col("partition") >= 4) & (F.dayofmonth("open_timestamp_utc") % 2 == 0)
    append_rows(updates.filter(~late), "kline", log)
    since = publish_table(spark, "kline", log, target, overlap=dt.timedelta(0))
    append_rows(updates.filter(late), "kline", log)
    publish_table(spark, "kline", log, target, since)
    return comparable(read_published(spark, "kline", target))


def klines_bucketed(spark, sf_dir):
    """Updates inserted into a bucketed table in two batches and reduced to the last without a shuffle."""
    database = "marketflow_buckets"
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{new_work_dir(spark)}'")
    table = f"{database}.klines"
    create_bucketed_klines(spark, table, 8)
    updates = raw_to_rows(adapters.klines(_rows(spark, sf_dir, "events")), "kline", *VERSION)
    for half in (1, 0):
        insert_bucketed(updates.filter(F.col("offset") % 2 == half), table)
    return comparable(read_bucketed(spark, table))


def trades_lookup(spark, sf_dir):
    """A market's trades between two ids, out of a table appended to in batches, the last after its summary."""
    root = new_work_dir(spark)
    path, summary = f"{root}/trades", f"{root}/summary"
    trades = normalize(adapters.trades(_rows(spark, sf_dir, "events")), "trade", carry=STORED)
    for batch in range(4):
        append_rows(trades.filter(F.least(F.floor(F.col("offset") / 400), F.lit(3)) == batch), "trade", path)
        if batch == 2:
            summarize_files(spark, "trade", path, summary, overlap=dt.timedelta(0))
    return comparable(lookup_rows(spark, "trade", path, summary, "CLICK", 700, 1300))


def stream_metrics(spark, sf_dir):
    """What the load of faulty trades counted by itself: rows, rejected rows, and each fault, over its micro-batches."""
    root = new_work_dir(spark)
    _stored_events(spark, sf_dir, root, 3)
    topics = FileTopics(f"{root}/raw", files_per_trigger=2)
    pipeline = Pipeline(spark, ["trade"], root, topics, topics)
    pipeline.route(adapters.faulty_trades(adapters.stream_rows(spark, root, "events"))).awaitTermination()
    query = start_direct(spark, "trade", topics, pipeline.table_path("trade"), f"{root}/checkpoints/direct", metrics=True)
    query.awaitTermination()
    # One row per micro-batch and count.
    counts = [(name, m[name]) for m in metrics_of(query) for name in ("rows", "rejected")]
    counts += [(fault, n) for m in metrics_of(query) for fault, n in m["faults"].items()]
    rows = spark.createDataFrame(counts, "metric string, n bigint")
    return rows.groupBy("metric").agg(F.sum("n").alias("n"))


def stream_klines_state(spark, sf_dir):
    """Candlesticks routed by a stream and kept as state by another, a file per micro-batch."""
    root = new_work_dir(spark)
    _stored_events(spark, sf_dir, root, 4)
    topics = FileTopics(f"{root}/raw", files_per_trigger=1)
    pipeline = Pipeline(spark, ["kline_1h"], root, topics, topics)
    pipeline.route(adapters.klines(adapters.stream_rows(spark, root, "events"))).awaitTermination()
    start_latest(spark, topics, f"{root}/latest", f"{root}/checkpoints/latest").awaitTermination()
    return comparable(read_latest(spark, f"{root}/latest"))


QUERIES = {
    "trades_normalized": trades_normalized,
    "agg_trades_normalized": agg_trades_normalized,
    "klines_normalized": klines_normalized,
    "klines_latest": klines_latest,
    "klines_latest_partitioned": klines_latest_partitioned,
    "mini_tickers_normalized": mini_tickers_normalized,
    "tickers_normalized": tickers_normalized,
    "avg_prices_normalized": avg_prices_normalized,
    "depth_top5": depth_top5,
    "routed_raw": routed_raw,
    "route_rejects": route_rejects,
    "route_repeated_keys": route_repeated_keys,
    "trades_repeated_keys": trades_repeated_keys,
    "subscription_filter": subscription_filter,
    "subscription_pairs": subscription_pairs_listed,
    "topics_of_endpoints": topics_of_endpoints,
    "valid_trades": valid_trades,
    "quarantine_reasons": quarantine_reasons,
    "processed_encoded": processed_encoded,
    "processed_roundtrip": processed_roundtrip,
    "trades_table": trades_table,
    "catalog_table": catalog_table,
    "klines_compacted": klines_compacted,
    "klines_recompacted": klines_recompacted,
    "stream_trades": stream_trades,
    "stream_klines_latest": stream_klines_latest,
    "stream_quarantine": stream_quarantine,
    "stream_compacted": stream_compacted,
    "stream_subscribed": stream_subscribed,
    "stream_dead_letters": stream_dead_letters,
    "stream_resumed": stream_resumed,
    "stream_rate_limited": stream_rate_limited,
    "backfilled_depths": backfilled_depths,
    "backfilled_twice": backfilled_twice,
    "backfilled_processed": backfilled_processed,
    "backfilled_gaps": backfilled_gaps,
    "backfilled_positions": backfilled_positions,
    "backfilled_range": backfilled_range,
    "topic_offsets": topic_offsets,
    "klines_published": klines_published,
    "klines_bucketed": klines_bucketed,
    "stream_klines_state": stream_klines_state,
    "stream_metrics": stream_metrics,
    "trades_lookup": trades_lookup,
}
