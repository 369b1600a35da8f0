"""Topics as Structured Streaming sources and sinks.

Two stores with the same interface: Kafka, and Parquet files with one partition folder
per topic. The file store needs no broker, so it also serves backfills and tests.
Records have the columns ``topic``, ``partition``, ``offset`` and ``value``.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from marketflow.operators.route import DEFAULT_PARTITIONS
from marketflow.schemas import kind_of

RECORD_COLUMNS = ("key", "partition", "offset", "value")

#: Spark splits files between row groups: with small ones many tasks share a micro-batch of one large file.
ROW_GROUP = "parquet.block.size"
ROW_GROUP_BYTES = 2 << 20
_STARTING = threading.Lock()

#: An offset for every partition, or one each; partitions that are not named are not bounded.
Offsets = int | Mapping[int, int]


@dataclass(frozen=True)
class Rate:
    """Most records per micro-batch (null: all there are) and how often a live one starts.

    With ``least`` a micro-batch waits until so many records are there, but not longer than
    ``delay``: it is flushed at N records or after T, whichever comes first.
    """

    records: int | None = None
    interval: str = "0 seconds"
    least: int | None = None
    delay: str | None = None

    def __post_init__(self) -> None:
        if (self.least is None) != (self.delay is None):
            raise ValueError("a micro-batch that waits for records needs a longest delay, and a delay a number of records")


# Published micro-batch limits of busy and of quiet kinds. Nothing is limited
# unless a rate is given, as a live job falls behind for good once more than that arrives.
BUSY = Rate(1000, "500 milliseconds")
QUIET = Rate(10, "1 second")


@contextmanager
def small_row_groups(spark: SparkSession) -> Iterator[None]:
    """Queries started meanwhile write files of small row groups, unless the session says otherwise.

    The file sink takes their size from the session when it starts, not from its writer's options.
    """
    with _STARTING:
        if spark.conf.get(ROW_GROUP, None) is not None:
            yield
            return
        spark.conf.set(ROW_GROUP, ROW_GROUP_BYTES)
        try:
            yield
        finally:
            spark.conf.unset(ROW_GROUP)


def published_rate(endpoint: str) -> Rate:
    return BUSY if kind_of(endpoint).name in ("trade", "aggTrade") else QUIET


def published_flush(endpoint: str) -> Rate:
    """The published buffers: flushed when full, or when their interval has passed. Nothing is limited."""
    full = published_rate(endpoint)
    return Rate(least=full.records, delay=full.interval)


def epoch_millis(instant: dt.datetime) -> int:
    """Milliseconds since 1970; an instant needs a time zone."""
    if instant.tzinfo is None:
        raise ValueError("a bound in time needs a time zone")
    return (instant - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(milliseconds=1)


def _one_bound(offsets: Offsets | None, instant: dt.datetime | None, end: str) -> None:
    if offsets is not None and instant is not None:
        raise ValueError(f"bound the {end} by offsets or by time, not by both")


def _bounded(rows: DataFrame, bound: Offsets | None, test: Callable[[Column, int], Column], others: bool = True) -> DataFrame:
    """Rows whose offset passes the test of its partition's bound, as filters that reach the scan."""
    if bound is None:
        return rows
    if not isinstance(bound, Mapping):
        return rows.filter(test(F.col("offset"), bound))
    each = [(F.col("partition") == p) & test(F.col("offset"), at) for p, at in sorted(bound.items())]
    if others:
        each.append(~F.col("partition").isin(*bound) if bound else F.lit(True))
    return rows.filter(reduce(Column.__or__, each, F.lit(False)))


def in_offsets(rows: DataFrame, start: Offsets | None = None, end: Offsets | None = None) -> DataFrame:
    """Records from ``start`` on and before ``end``."""
    return _bounded(_bounded(rows, start, Column.__ge__), end, Column.__lt__)


def offsets_at(rows: DataFrame, instant: dt.datetime) -> dict[int, int]:
    """Per partition the smallest offset of a record as late as ``instant``; partitions without one are left out.

    At most one row per partition of the topic comes to the driver.
    """
    late = rows.filter(F.col("timestamp") >= F.timestamp_millis(F.lit(epoch_millis(instant))))
    found = late.groupBy("partition").agg(F.min("offset").alias("first")).collect()
    return {r["partition"]: r["first"] for r in found}


def in_range(
    rows: DataFrame,
    start: Offsets | None,
    end: Offsets | None,
    since: dt.datetime | None,
    until: dt.datetime | None,
) -> DataFrame:
    """Records of a range of offsets, or of time resolved to offsets, as a broker resolves it.

    A partition's range begins at the first offset whose record is as late as ``since`` and
    ends before the first one as late as ``until``; offsets in between belong to it whatever
    their times.
    """
    _one_bound(start, since, "start")
    _one_bound(end, until, "end")
    out = in_offsets(rows, start, end)
    if since is not None:
        out = _bounded(out, offsets_at(rows, since), Column.__ge__, others=False)
    if until is not None:
        out = _bounded(out, offsets_at(rows, until), Column.__lt__)
    return out


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster (needs Spark's Kafka connector on the class path)."""

    bootstrap_servers: str
    partitions: int = DEFAULT_PARTITIONS
    options: Mapping[str, str] = field(default_factory=dict)
    allow_data_loss: bool = False

    def source_options(
        self, topic: str, max_records: int | None = None, least: int | None = None, delay: str | None = None
    ) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            "minPartitions": str(self.partitions),
            "failOnDataLoss": str(not self.allow_data_loss).lower(),
        }
        if max_records:
            options["maxOffsetsPerTrigger"] = str(max_records)
        if least:
            options |= {"minOffsetsPerTrigger": str(least), "maxTriggerDelay": delay}
        return {**options, **self.options}

    def read_stream(
        self,
        spark: SparkSession,
        topic: str,
        max_records: int | None = None,
        start: Offsets | None = None,
        since: dt.datetime | None = None,
        least: int | None = None,
        delay: str | None = None,
    ) -> DataFrame:
        """A topic from its earliest record, or from offsets or a time; a checkpoint goes before either.

        ``max_records`` limits a micro-batch; ``least`` and ``delay`` let it wait (see ``Rate``).
        """
        options = {**self.source_options(topic, max_records, least, delay), **self._bound(topic, "starting", start, since)}
        return spark.readStream.format("kafka").options(**options).load().select("topic", *RECORD_COLUMNS)

    def _bound(self, topic: str, side: str, offsets: Offsets | None, instant: dt.datetime | None) -> dict[str, str]:
        """The connector's options for one end of a range."""
        _one_bound(offsets, instant, side)
        # What the connector takes for the earliest and for the latest offset.
        unbounded, named = (-2, "earliest") if side == "starting" else (-1, "latest")
        if instant is not None:
            # Where nothing is as late, a range begins, or ends, with what is there.
            strategy = {"startingOffsetsByTimestampStrategy": "latest"} if side == "starting" else {}
            return {f"{side}Timestamp": str(epoch_millis(instant)), **strategy}
        if offsets is None:
            return {f"{side}Offsets": named}
        if isinstance(offsets, Mapping):
            strange = [p for p in offsets if not 0 <= p < self.partitions]
            if strange:
                raise ValueError(f"{topic} has partitions 0 to {self.partitions - 1}, not {strange}")
            every = {str(p): offsets.get(p, unbounded) for p in range(self.partitions)}
        else:
            every = {str(p): offsets for p in range(self.partitions)}
        return {f"{side}Offsets": json.dumps({topic: every})}

    def range_options(
        self,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
        since: dt.datetime | None = None,
        until: dt.datetime | None = None,
    ) -> dict[str, str]:
        """A range of offsets, the same or another one in every partition, or of time; ends are not read."""
        ends = {**self._bound(topic, "starting", start, since), **self._bound(topic, "ending", end, until)}
        return {**self.source_options(topic), **ends}

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
        *,
        since: dt.datetime | None = None,
        until: dt.datetime | None = None,
    ) -> DataFrame:
        """What is on the topic so far, or a range of offsets or of time, for backfills."""
        options = self.range_options(topic, start, end, since, until)
        return spark.read.format("kafka").options(**options).load().select("topic", *RECORD_COLUMNS)

    def sink_folder(self, topic: str | None = None) -> None:
        """No folder: topics of a broker take records of any number of queries."""
        return None

    def writer(self, records: DataFrame, topic: str | None = None) -> DataStreamWriter:
        """Sink for ``topic``, ``partition``, ``value``; Kafka assigns the offsets."""
        return (
            records.select("topic", "partition", *(c for c in records.columns if c == "key"), "value")
            .writeStream.outputMode("append")
            .format("kafka")
            .option("kafka.bootstrap.servers", self.bootstrap_servers)
            .options(**self.options)
        )


def topic_records(records: DataFrame, offset: Column) -> DataFrame:
    """Records as file topics store them; those without a key or a time get none, and the present one."""
    key = F.col("key") if "key" in records.columns else F.lit(None)
    time = F.col("timestamp") if "timestamp" in records.columns else F.current_timestamp()
    return records.select(
        "topic", key.cast("string").alias("key"), F.col("partition").cast("int"), offset.alias("offset"),
        F.col("value").cast("string"), time.cast("timestamp").alias("timestamp"),
    )


@dataclass(frozen=True)
class FileTopics:
    """Topics as Parquet files below ``path``, exactly once through the file sink's log.

    A sink's folder belongs to one query: another query's batches would be taken for
    batches already written. With ``per_topic`` every topic has a folder and a writing
    query of its own; without, one query writes all topics, and every reader follows the one
    log of all of them: meant for drains, backfills and tests, not for live jobs.
    """

    path: str
    per_topic: bool = False
    files_per_trigger: int | None = None

    SCHEMA = "key string, partition int, offset bigint, value string, timestamp timestamp, topic string"

    def sink_folder(self, topic: str | None = None) -> str:
        return f"{self.path}/{topic}" if self.per_topic else self.path

    def read_stream(
        self,
        spark: SparkSession,
        topic: str,
        max_records: int | None = None,
        start: Offsets | None = None,
        since: dt.datetime | None = None,
        least: int | None = None,
        delay: str | None = None,
    ) -> DataFrame:
        """Files are limited by count (``files_per_trigger``); records cannot be.

        A time is resolved to offsets from what is there when the stream is defined: records that
        come later may all be read, so a partition without a record as late has no bound.
        """
        if least or delay:
            raise ValueError("file topics cannot wait for records")
        if max_records:
            raise ValueError("file topics are limited by files_per_trigger, not by records")
        _one_bound(start, since, "start")
        if since is not None:
            start = self._first_offsets(spark, topic, since)
        reader = spark.readStream.schema(self.SCHEMA)
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.files_per_trigger)
        files = reader.parquet(self.sink_folder(topic))
        return in_offsets(files.filter(F.col("topic") == topic), start).select("topic", *RECORD_COLUMNS)

    def _stored(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.schema(self.SCHEMA).parquet(self.sink_folder(topic)).filter(F.col("topic") == topic)

    def _first_offsets(self, spark: SparkSession, topic: str, since: dt.datetime) -> dict[int, int]:
        """Where each partition's records from ``since`` on begin: after all that are there, if none is as late."""
        there = self._stored(spark, topic)
        ends = {r["partition"]: r["last"] + 1 for r in there.groupBy("partition").agg(F.max("offset").alias("last")).collect()}
        return {**ends, **offsets_at(there, since)}

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
        *,
        since: dt.datetime | None = None,
        until: dt.datetime | None = None,
    ) -> DataFrame:
        """What is on the topic so far, or a range of offsets or of record times."""
        return in_range(self._stored(spark, topic), start, end, since, until).select("topic", *RECORD_COLUMNS)

    def writer(self, records: DataFrame, topic: str | None = None) -> DataStreamWriter:
        """Sink for records of ``topic``, or of all topics; offsets are kept, as no broker assigns them.

        Records without a ``timestamp`` get the time of writing, as a broker gives it.
        """
        if self.per_topic != (topic is not None):
            raise ValueError("a folder per topic takes one topic's records, a shared folder one query for all topics")
        return (
            topic_records(records, F.col("offset").cast("bigint"))
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", self.sink_folder(topic))
            .partitionBy("topic")
        )
