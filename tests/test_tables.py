"""Keep-latest, tables, compaction and plans."""

from __future__ import annotations

import datetime as dt
import json
import random
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketflow import (
    KINDS,
    Subscriptions,
    decode_processed,
    encode_processed,
    filter_subscribed,
    latest_klines,
    normalize,
    route_raw,
    subscription_pairs,
    validate,
)
from marketflow.operators.latest import VERSION
from marketflow.plans import queries
from marketflow.plans.batch import STORED, raw_to_rows
from marketflow.sources.tables import settled_and_added
from marketflow.sources import (
    append_rows,
    compact_table,
    create_tables,
    insert_rows,
    new_work_dir,
    read_compacted,
    read_quarantine,
    read_table,
    register_views,
)
from test_messages import DEPTH, KLINE, T0, TRADE, raw

DAY = 86_400_000


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def kline(symbol, opened, version, mark):
    bar = {**KLINE["k"], "s": symbol, "t": opened, "T": opened + 59_999, "i": "1m", "f": mark, "L": mark}
    return {**KLINE, "s": symbol, "E": version, "k": bar}


def stored_klines(spark, messages):
    return normalize(raw(spark, *messages), "kline", carry=STORED)


def test_latest_against_brute_force(spark):
    """Most updates are of one symbol, and versions tie within a millisecond."""
    chance = random.Random(7)
    messages, best = [], {}
    for offset in range(3000):
        symbol = "HOT" if chance.random() < 0.7 else f"S{chance.randrange(20)}"
        opened = T0 - T0 % 60_000 + 60_000 * chance.randrange(5)
        version = opened + chance.randrange(300)
        messages.append(kline(symbol, opened, version, offset))
        key = (symbol, opened // 1000)
        best[key] = max(best.get(key, (0, 0)), (version, offset))
    rows = latest_klines(raw_to_rows(raw(spark, *messages).repartition(7), "kline", *VERSION))
    got = {
        (r.symbol, r.opened): (r.event_ms, r.first_trade_id)
        for r in rows.select(
            "symbol", "first_trade_id", F.unix_seconds("open_timestamp_utc").alias("opened"),
            "event_ms",
        ).collect()
    }
    assert got == best


def test_latest_reduces_before_the_exchange(spark):
    text = plan(latest_klines(raw_to_rows(raw(spark, KLINE), "kline", *VERSION)))
    tree = text[: text.index("(1)")] if "(1)" in text else text
    assert text.count("Arguments: hashpartitioning") == 1
    assert tree.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name, message", [("kline", KLINE), ("depth", DEPTH), ("trade", TRADE)])
def test_messages_are_parsed_once_without_a_shuffle(spark, tmp_path, name, message):
    raw(spark, message).write.parquet(str(tmp_path / "raw"))
    source = spark.read.parquet(str(tmp_path / "raw"))
    text = plan(raw_to_rows(source, name))
    assert text.count("from_json(") == 1
    assert "Exchange" not in text
    assert "ReadSchema: struct<value:string>" in text
    text = plan(filter_subscribed(route_raw(source), Subscriptions.of(["BTCUSDT"], ["trade"])))
    assert text.count("parseJson(") == 1
    assert "Exchange" not in text
    processed = plan(validate(decode_processed(source, name), name).filter("reject_reason is null"))
    assert processed.count("from_json(") == 1


def test_append_and_read(spark, tmp_path):
    path = str(tmp_path / "trades")
    messages = [{**TRADE, "t": i, "E": T0 + i * DAY} for i in range(4)]
    rows = normalize(raw(spark, *messages, {**TRADE, "p": "x"}), "trade", carry=("partition", "offset", "value"))
    append_rows(rows, "trade", path)
    append_rows(rows.filter("trade_id = 3"), "trade", path)
    table = read_table(spark, "trade", path)
    assert table.columns == list(KINDS["trade"].columns)
    assert sorted(r.trade_id for r in table.collect()) == [0, 1, 2, 3, 3]
    some = read_table(spark, "trade", path, start="2023-11-15", end="2023-11-17")
    assert sorted(r.trade_id for r in some.collect()) == [1, 2]
    assert "event_date" in plan(some).split("PartitionFilters: ")[1].split("\n")[0]
    (bad,) = read_quarantine(spark, "trade", path).collect()
    assert (bad.offset, bad.reject_reason) == (4, "missing price")
    assert '"p": "x"' in bad.value


def test_only_rejected_rows_keep_their_text(spark, tmp_path):
    path = str(tmp_path / "trades")
    append_rows(normalize(raw(spark, TRADE), "trade", carry=("partition", "offset", "value")), "trade", path)
    assert spark.read.parquet(path).select("rejected_value").collect() == [(None,)]


def test_dates_do_not_depend_on_the_session_zone(spark, tmp_path):
    path = str(tmp_path / "trades")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        append_rows(normalize(raw(spark, TRADE), "trade", carry=("partition", "offset", "value")), "trade", path)
        assert spark.read.parquet(path).select(F.col("event_date").cast("string")).collect() == [("2023-11-14",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_kline_table_gives_the_last_update(spark, tmp_path):
    path = str(tmp_path / "klines")
    opened = T0 - T0 % 60_000
    append_rows(stored_klines(spark, [kline("A", opened, T0, 1), kline("A", opened, T0 + 5000, 2)]), "kline", path)
    append_rows(stored_klines(spark, [kline("A", opened, T0 + 1000, 3)]), "kline", path)
    assert [r.first_trade_id for r in read_table(spark, "kline", path).collect()] == [2]
    assert read_table(spark, "kline", path, all_updates=True).count() == 3


def test_later_updates_win_across_topic_partitions(spark, tmp_path):
    """Offsets of two partitions do not compare: the closing update has the smaller one."""
    opened = T0 - T0 % 60_000
    closing = kline("A", opened, opened + 900, 1)
    closing["k"]["x"] = True
    earlier = kline("A", opened, opened + 100, 2)
    messages = spark.createDataFrame(
        [(json.dumps(closing), 2, 10), (json.dumps(earlier), 1, 900)], "value string, partition int, offset bigint"
    )
    rows = latest_klines(raw_to_rows(messages, "kline", *VERSION))
    assert [r.first_trade_id for r in rows.collect()] == [1]
    direct, staged, copy = (str(tmp_path / n) for n in ("direct", "staged", "copy"))
    append_rows(normalize(messages, "kline", carry=STORED), "kline", direct)
    processed = encode_processed(normalize(messages, "kline", carry=("partition", "offset", "event_ms")), "kline", ("offset",))
    append_rows(decode_processed(processed, "kline", carry=STORED), "kline", staged)
    compact_table(spark, "kline", staged, copy)
    for table in (read_table(spark, "kline", direct), read_table(spark, "kline", staged), spark.read.parquet(copy)):
        assert [r.first_trade_id for r in table.collect()] == [1]


def test_compaction_rebuilds_only_touched_dates(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "latest")
    days = [T0 - T0 % DAY + n * DAY for n in range(4)]
    append_rows(stored_klines(spark, [kline("A", d, d, n) for n, d in enumerate(days)]), "kline", log)
    now = dt.datetime.now(dt.timezone.utc)
    assert compact_table(spark, "kline", log, target) < (now - dt.timedelta(hours=23)).isoformat()
    time.sleep(0.1)
    since = compact_table(spark, "kline", log, target, overlap=dt.timedelta(0))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "latest").rglob("open_date=*/*.parquet")}
    time.sleep(0.1)
    append_rows(stored_klines(spark, [kline("A", days[1], days[1] + 1000, 11), kline("B", days[2], days[2], 12)]), "kline", log)
    settled, added = settled_and_added(spark, "kline", log, target, since)
    assert sorted(r.first_trade_id for r in settled.collect()) == [0, 3]
    assert sorted(r.first_trade_id for r in added.collect()) == [2, 11, 12]
    # The log's files are pruned by the range of touched dates and, within it, by the dates.
    scan = plan(added)
    assert "dynamicpruning" in scan
    filters = [line for line in scan.splitlines() if "PartitionFilters" in line and "dynamicpruning" in line]
    assert filters and all("open_date" in f and ">=" in f and "<=" in f for f in filters)
    assert read_compacted(spark, "kline", log, target, since).columns == list(KINDS["kline"].columns)
    compact_table(spark, "kline", log, target, since=since)
    ids = [r.first_trade_id for r in spark.read.parquet(target).orderBy("first_trade_id").collect()]
    assert ids == [0, 2, 3, 11, 12]
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "latest").rglob("open_date=*/*.parquet")}
    assert {p for p in before if before[p] == after.get(p)} == {p for p in before if "-14" in str(p) or "-17" in str(p)}
    compact_table(spark, "kline", log, target, since=since)
    assert spark.read.parquet(target).count() == 5


def test_compacted_queries_hold_settled_and_rebuilt_rows(spark):
    log, target, since = queries._compacted_klines(spark, "/root/testdata/sf0.001")
    settled, added = settled_and_added(spark, "kline", log, target, since)
    assert settled.count() > 0 and added.count() > 0
    assert read_compacted(spark, "kline", log, target, "2100-01-01T00:00:00").count() == spark.read.parquet(target).count()


def test_no_registered_plan_deals_rows_out(spark):
    for name, query in queries.QUERIES.items():
        if not name.startswith(("stream_", "backfilled_")):
            assert "RoundRobinPartitioning" not in plan(query(spark, "/root/testdata/sf0.001")), name


def test_compaction_opens_only_recent_files(spark, tmp_path):
    log = str(tmp_path / "log")
    append_rows(stored_klines(spark, [kline("A", T0, T0, 1)]), "kline", log)
    compact_table(spark, "kline", log, str(tmp_path / "latest"), since="2100-01-01T00:00:00")
    assert not list((tmp_path / "latest").glob("open_date=*"))


def test_a_busy_symbol_is_written_in_parts(spark, tmp_path):
    """One symbol and date holds every row; adaptive execution still splits the write."""
    path = str(tmp_path / "trades")
    source = spark.range(0, 60_000, 1, 8).select(
        F.lit(json.dumps(TRADE)).alias("template"), F.lit(0).alias("partition"), F.col("id").alias("offset")
    )
    value = F.replace("template", F.lit('"t": 1'), F.concat(F.lit('"t": '), F.col("offset").cast("string")))
    rows = normalize(source.withColumn("value", value), "trade", carry=("partition", "offset", "value"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        append_rows(rows, "trade", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "trades").rglob("*.parquet"))) > 1
    assert read_table(spark, "trade", path).agg(F.count_distinct("trade_id")).first()[0] == 60_000


def test_catalog_tables_are_created_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE tables_test LOCATION '{tmp_path / 'db'}'")
    try:
        endpoints = ["trade", "kline_3m", "kline_5m"]
        assert create_tables(spark, endpoints, "tables_test") == ["tables_test.trades", "tables_test.klines"]
        insert_rows(raw_to_rows(raw(spark, TRADE), "trade"), "trade", "tables_test.trades")
        create_tables(spark, endpoints, "tables_test")
        assert spark.table("tables_test.trades").count() == 1
        columns = spark.table("tables_test.klines").columns
        assert columns == [*KINDS["kline"].columns, "open_date"]
    finally:
        spark.sql("DROP DATABASE tables_test CASCADE")


def test_views(spark, tmp_path):
    append_rows(
        normalize(raw(spark, TRADE), "trade", carry=("partition", "offset", "value")), "trade", str(tmp_path / "trades")
    )
    assert register_views(spark, ["trade"], str(tmp_path)) == ["trades"]
    assert spark.sql("SELECT symbol, sum(quantity) AS q FROM trades GROUP BY symbol").collect()[0].q == 2


def test_subscription_lists():
    wanted = Subscriptions.of(["BTCUSDT", "", None], ["trade", ""])
    assert wanted == Subscriptions(("btcusdt",), ("trade",))
    for markets, endpoints in (([], ["trade"]), (["A"], []), (None, ["trade"]), ([""], ["trade"])):
        with pytest.raises(ValueError):
            Subscriptions.of(markets, endpoints)


@pytest.mark.parametrize("others", [0, 20_000])
def test_subscription_filter(spark, others):
    other = {**KLINE, "k": {**KLINE["k"], "i": "5m"}}
    messages = [TRADE, {**TRADE, "s": "XRPUSDT"}, KLINE, other, DEPTH, "junk"]
    wanted = Subscriptions.of(["BTCUSDT", "ethusdt", *(f"M{i}" for i in range(others))], ["trade", "kline_3m"])
    kept = filter_subscribed(route_raw(raw(spark, *messages), carry=("offset",)), wanted)
    assert sorted(r.offset for r in kept.collect()) == [0, 2]
    assert kept.columns == route_raw(raw(spark, TRADE), carry=("offset",)).columns
    assert "Exchange" not in plan(kept) and "Join" not in plan(kept)
    every = filter_subscribed(route_raw(raw(spark, *messages), carry=("offset",)), Subscriptions.of_endpoints(["kline"]))
    assert sorted(r.offset for r in every.collect()) == [2, 3]


def test_subscription_pairs(spark):
    markets = spark.createDataFrame([("BTCUSDT",), ("",), ("ethusdt",)], "market string")
    got = sorted(r.subscription for r in subscription_pairs(markets, ["trade", "", "kline_3m"]).collect())
    assert got == ["btcusdt@kline_3m", "btcusdt@trade", "ethusdt@kline_3m", "ethusdt@trade"]
    with pytest.raises(ValueError):
        subscription_pairs(markets, [""])


def test_work_folder_is_below_the_shared_one():
    def session(master, **conf):
        settings = SimpleNamespace(get=lambda key, default=None: conf.get(key.split(".")[-2], default))
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))

    assert new_work_dir(session("yarn", checkpoint="s3://shared/")).startswith("s3://shared/marketflow-")
    assert new_work_dir(session("local[8]", checkpoint="/shared")).startswith("/shared/marketflow-")
    for master in ("local[8]", "spark://host:7077"):
        assert new_work_dir(session(master, warehouse="/tables")).startswith("/tables/marketflow-")
