"""The ledger of positions, numbered topics and ranges."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from marketflow import normalize
from marketflow.plans.batch import STORED, backfill
from marketflow.sources import FileTopics, KafkaTopics, NumberedTopics, append_rows, read_table, stored_positions, with_offsets
from marketflow.sources import positions, tables
from marketflow.sources.positions import ENTRIES_PER_BASE, Ledger, intervals_of, merged, without_positions
from marketflow.sources.topics import offsets_at
from test_messages import T0, TRADE
from test_tables import plan

INTERVALS = "`partition` int, first bigint, last bigint"
UTC = dt.timezone.utc


def found(intervals) -> list[tuple]:
    return sorted(tuple(r) for r in intervals.collect())


def covered(intervals) -> dict[int, set[int]]:
    out: dict[int, set[int]] = {}
    for p, first, last in intervals:
        out.setdefault(p, set()).update(range(first, last + 1))
    return out


@pytest.mark.parametrize("bits", [2, 5, 20])
def test_intervals_merge_to_the_fewest_whatever_the_ranges(spark, bits):
    chance = random.Random(bits)
    given = []
    for _ in range(300):
        first = chance.randrange(400)
        given.append((chance.randrange(3), first, first + chance.choice([0, 0, 1, 3, 30])))
    want = []
    for p, offsets in covered(given).items():
        for offset in sorted(offsets):
            if want and want[-1][0] == p and want[-1][2] == offset - 1:
                want[-1][2] = offset
            else:
                want.append([p, offset, offset])
    frame = spark.createDataFrame(given, INTERVALS)
    assert found(merged(frame, bits)) == sorted(map(tuple, want))
    assert found(merged(frame.limit(0), bits)) == []


def test_positions_become_intervals_and_nulls_are_left_out(spark):
    rows = spark.createDataFrame(
        [(0, 5), (0, 6), (0, 6), (0, 8), (1, 7), (None, 3), (2, None)], "`partition` int, `offset` bigint"
    )
    assert found(intervals_of(rows, 1)) == [(0, 5, 6), (0, 8, 8), (1, 7, 7)]


@pytest.mark.parametrize("most", [0, 1000])
def test_stored_positions_are_left_out_by_either_plan(spark, most):
    chance = random.Random(1)
    given = [(p, a, a + chance.randrange(6)) for p in range(3) for a in range(0, 500, 11)] + [(0, 100, 400), (5, 0, 1 << 30)]
    rows = [(chance.randrange(6), chance.randrange(600), f"v{n}", None) for n in range(2000)]
    rows += [(None, 3, "a", None), (1, None, "b", 2), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "`partition` int, `offset` bigint, value string, last int")
    left = without_positions(frame, spark.createDataFrame(given, INTERVALS), bits=6 if most else 20, most=most)
    assert left.columns == frame.columns
    gone = [(p, a, b) for p, a, b in given]
    want = [r for r in rows if None in r[:2] or not any(p == r[0] and a <= r[1] <= b for p, a, b in gone)]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in left.collect()), key=key) == sorted(want, key=key)
    assert ("hashpartitioning" in plan(left)) == (most == 0)


def trades(spark, ids, partitions: int = 3):
    rows = [(json.dumps({**TRADE, "t": i, "E": T0 + i}), i % partitions, i // partitions) for i in ids]
    return normalize(spark.createDataFrame(rows, "value string, `partition` int, `offset` bigint"), "trade", carry=STORED)


def ids_of(spark, path) -> list[int]:
    return sorted(r.trade_id for r in read_table(spark, "trade", path).collect())


def test_a_rerun_does_not_read_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "trades")
    append_rows(trades(spark, range(30)), "trade", path, skip_stored=True)
    seen = []
    monkeypatch.setattr(tables, "table_rows", lambda rows, name, real=tables.table_rows: seen.append(rows) or real(rows, name))
    append_rows(trades(spark, range(40)), "trade", path, skip_stored=True)
    (rows,) = seen
    scans = [line for line in plan(rows).splitlines() if "Location" in line]
    assert scans and all("_positions/entry" in line for line in scans)
    assert ids_of(spark, path) == list(range(40))
    assert found(stored_positions(spark, path)) == [(0, 0, 13), (1, 0, 12), (2, 0, 12)]


def test_a_table_filled_without_a_ledger_gets_one(spark, tmp_path):
    path = str(tmp_path / "trades")
    append_rows(trades(spark, range(10)), "trade", path)
    append_rows(trades(spark, range(20)), "trade", path, skip_stored=True)
    append_rows(trades(spark, range(20, 25)), "trade", path)
    append_rows(trades(spark, range(30)), "trade", path, skip_stored=True)
    assert ids_of(spark, path) == list(range(30))


def test_appends_that_broke_off_are_settled_from_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "trades")
    append_rows(trades(spark, range(6)), "trade", path, skip_stored=True)
    with monkeypatch.context() as patch:
        # The rows get in, the note of their positions does not.
        patch.setattr(Ledger, "settle", lambda self: None)
        append_rows(trades(spark, range(6, 12)), "trade", path, skip_stored=True)
    Ledger(spark, path).begin()  # One that ended before it wrote anything.
    assert Ledger(spark, path).pending().count() == 2
    append_rows(trades(spark, range(15)), "trade", path, skip_stored=True)
    assert ids_of(spark, path) == list(range(15)) and Ledger(spark, path).pending() is None


def test_an_entry_now_and_then_holds_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(positions, "ENTRIES_PER_BASE", 3)
    path = str(tmp_path / "trades")
    for n in range(8):
        append_rows(trades(spark, range(3 * n, 3 * n + 4)), "trade", path, skip_stored=True)
    assert ids_of(spark, path) == list(range(25)) and ENTRIES_PER_BASE > 3
    ledger = Ledger(spark, path)
    base, last = ledger._entries()
    assert last >= 8 and last - base < 3
    assert found(stored_positions(spark, path)) == [(0, 0, 8), (1, 0, 7), (2, 0, 7)]


def test_quarantined_rows_have_positions_too(spark, tmp_path):
    path = str(tmp_path / "trades")
    rows = spark.createDataFrame([("{broken", 0, 0), (json.dumps(TRADE), 0, 1)], "value string, `partition` int, `offset` bigint")
    for _ in range(2):
        append_rows(normalize(rows, "trade", carry=STORED), "trade", path, skip_stored=True)
    assert spark.read.parquet(path).count() == 2


def records(spark, n: int, first: int = 0, tasks: int = 5):
    rows = spark.range(first, first + n, 1, tasks)
    hot = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 9).cast("int")
    time = F.timestamp_millis(F.lit(T0) + F.col("id") * 1000)
    return rows.select(F.lit("trade_raw").alias("topic"), hot.alias("partition"), F.col("id").cast("string").alias("value"), time.alias("timestamp"))


def test_numbers_are_dense_per_topic_partition_in_reading_order(spark):
    numbered = with_offsets(records(spark, 1000)).collect()
    by: dict = {}
    for r in numbered:
        by.setdefault((r.topic, r.partition), []).append((r.offset, int(r.value)))
    for rows in by.values():
        rows.sort()
        assert [o for o, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)
    assert len(by) == 3 and with_offsets(records(spark, 0)).collect() == []
    # A topic partition with most records is numbered task by task.
    text = plan(with_offsets(records(spark, 100)))
    assert "rangepartitioning" not in text and "SinglePartition" not in text


def test_batches_go_on_and_half_written_ones_do_not_count(spark, tmp_path):
    topics = NumberedTopics(str(tmp_path / "raw"))
    assert topics.read(spark, "trade_raw").collect() == [] and topics.ends(spark).collect() == []
    assert topics.append(records(spark, 90)) == 0
    # A batch whose ends were never written.
    with_offsets(records(spark, 50)).write.partitionBy("topic").parquet(f"{topics.path}/records/batch=1")
    assert topics.read(spark, "trade_raw").count() == 90
    assert topics.append(records(spark, 60, 90)) == 1
    assert topics.append(records(spark, 0)) == 2
    got = topics.read(spark, "trade_raw").select("partition", "offset", F.col("value").cast("int")).collect()
    assert sorted(r.value for r in got) == list(range(150))
    ends = {r.partition: r.next_offset for r in topics.ends(spark).collect()}
    for p, end in ends.items():
        assert sorted(r.offset for r in got if r.partition == p) == list(range(end))
    first = {(r.partition, r.offset) for r in got if r.value < 90}
    assert max(o for p, o in first if p == 0) < min(r.offset for r in got if r.partition == 0 and r.value >= 90)


def test_a_stream_numbers_its_batches_and_repeats_change_nothing(spark, tmp_path):
    topics, feed = NumberedTopics(str(tmp_path / "raw")), str(tmp_path / "feed")
    for n in range(2):
        records(spark, 30, 30 * n).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(records(spark, 1).schema).parquet(feed)
        topics.start(stream, str(tmp_path / "checkpoint")).awaitTermination()
    before = found(topics.read(spark, "trade_raw").select("partition", "offset", "value"))
    topics.write_batch(records(spark, 30, 30), 1)
    assert found(topics.read(spark, "trade_raw").select("partition", "offset", "value")) == before and len(before) == 60
    with pytest.raises(ValueError):
        topics.append(records(spark, 1))


def test_ranges_by_partition_and_by_time(spark, tmp_path):
    topics = NumberedTopics(str(tmp_path / "raw"))
    topics.append(records(spark, 300, tasks=1))
    rows = topics.read(spark, "trade_raw")
    some = topics.read(spark, "trade_raw", start={0: 150, 3: 20}, end={0: 160, 6: 5})
    want = sorted((r.partition, r.offset) for r in rows.collect() if (r.partition == 0 and 150 <= r.offset < 160) or (r.partition == 3 and r.offset >= 20) or (r.partition == 6 and r.offset < 5))
    assert sorted((r.partition, r.offset) for r in some.collect()) == want
    assert "PushedFilters" in plan(some) and "GreaterThanOrEqual(offset,150)" in plan(some)
    at = lambda n: dt.datetime.fromtimestamp(T0 / 1000, UTC) + dt.timedelta(seconds=n)
    values = lambda frame: sorted(int(r.value) for r in frame.collect())
    assert values(topics.read(spark, "trade_raw", since=at(100), until=at(200))) == list(range(100, 200))
    assert values(topics.read(spark, "trade_raw", since=at(299.5))) == []
    assert values(topics.read(spark, "trade_raw", until=at(1000))) == list(range(300))
    assert values(topics.read(spark, "trade_raw", start={}, end=None)) == list(range(300))
    with pytest.raises(ValueError):
        topics.read(spark, "trade_raw", start=1, since=at(1))
    with pytest.raises(ValueError):
        topics.read(spark, "trade_raw", since=dt.datetime(2024, 1, 1))


def test_late_records_between_the_bounds_belong_to_a_range(spark):
    """As a broker resolves it: from the first record as late as the bound on, by offset."""
    times = [10, 20, 15, 30, 25]
    rows = [(0, n, dt.datetime.fromtimestamp(t, UTC)) for n, t in enumerate(times)]
    frame = spark.createDataFrame(rows, "`partition` int, `offset` bigint, timestamp timestamp")
    at = lambda t: offsets_at(frame, dt.datetime.fromtimestamp(t, UTC))
    assert at(12) == {0: 1} and at(16) == {0: 1} and at(25) == {0: 3} and at(31) == {}


def test_file_topics_take_ranges_in_batch_and_as_streams(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "raw"), per_topic=True)
    rows = records(spark, 60, tasks=1).withColumn("offset", F.col("value").cast("long"))
    folder = topics.sink_folder("trade_raw")
    rows.write.partitionBy("topic").parquet(folder)
    since = dt.datetime.fromtimestamp(T0 / 1000 + 40, UTC)
    for n, options in enumerate(({"start": {0: 50}}, {"since": since})):
        batch = {(r.partition, r.offset) for r in topics.read(spark, "trade_raw", **options).collect()}
        stream = topics.read_stream(spark, "trade_raw", **options)
        out = stream.writeStream.format("memory").queryName(f"ranged{n}").trigger(availableNow=True).start()
        out.awaitTermination()
        assert {(r.partition, r.offset) for r in spark.table(f"ranged{n}").collect()} == batch
        assert 0 < len(batch) < 60


def test_kafka_ranges():
    kafka = KafkaTopics("b", partitions=3)
    options = kafka.range_options("t", {1: 7}, {0: 9, 2: 4})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": -2, "1": 7, "2": -2}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 9, "1": -1, "2": 4}}
    instant = dt.datetime(2024, 1, 2, tzinfo=UTC)
    options = kafka.range_options("t", since=instant, until=instant + dt.timedelta(hours=1))
    assert options["startingTimestamp"] == "1704153600000" and options["endingTimestamp"] == "1704157200000"
    assert options["startingOffsetsByTimestampStrategy"] == "latest" and "endingOffsets" not in options
    assert kafka.range_options("t")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka.range_options("t", {3: 1})
    with pytest.raises(ValueError):
        kafka.range_options("t", 5, since=instant)


def test_backfills_by_partition_fill_gaps_once(spark, tmp_path):
    topics, path = NumberedTopics(str(tmp_path / "raw")), str(tmp_path / "trades")
    value = F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in TRADE.items() if k != "t"), F.col("value").cast("int").alias("t")))
    topics.append(records(spark, 60).withColumn("value", value))
    backfill(spark, "trade", topics, path, start={0: 5}, end={0: 20, 3: 4, 6: 2})
    assert (0, 5, 19) in found(stored_positions(spark, path))
    for _ in range(2):
        backfill(spark, "trade", topics, path)
        assert ids_of(spark, path) == list(range(60))
    ends = {r.partition: r.next_offset - 1 for r in topics.ends(spark).collect()}
    assert found(stored_positions(spark, path)) == [(p, 0, ends[p]) for p in sorted(ends)]
