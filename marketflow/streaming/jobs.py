"""Streaming jobs: route, transform and load, each with its own checkpoint.

``live=True`` runs until stopped; the default drains what is there and ends. A checkpoint makes
stopping and starting again safe either way. A ``Rate`` limits micro-batches in both modes.
All jobs are map-only: no shuffle and no state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marketflow.operators import (
    Subscriptions,
    decode_processed,
    encode_processed,
    is_subscribed,
    normalize,
    route_raw,
    routed_messages,
)
from marketflow.operators.route import DEFAULT_PARTITIONS
from marketflow.operators.validate import REASON
from marketflow.schemas import EVENT_MS, Kind, distinct_kinds, kind_of
from marketflow.sources.tables import partition_columns, table_rows
from marketflow.sources.topics import FileTopics, KafkaTopics, Rate, small_row_groups
from marketflow.sources.work import claim_stream_folder
from marketflow.streaming.metrics import observed
from marketflow.streaming.supervise import Outcome, supervise

Topics = FileTopics | KafkaTopics

DEAD_LETTERS = "dead_letters"
# Rejected messages that lose nothing.
NO_LOSS = ("acknowledgement", "unknown event")


def _start(
    spark: SparkSession,
    writer: DataStreamWriter,
    folder: str | None,
    checkpoint: str,
    name: str,
    live: bool,
    rate: Rate | None = None,
) -> StreamingQuery:
    if folder:
        claim_stream_folder(spark, folder, checkpoint)
    # Names of running queries differ within a session; so do checkpoints.
    writer = writer.option("checkpointLocation", checkpoint).queryName(f"{name} {checkpoint}")
    every = {"processingTime": rate.interval if rate else "0 seconds"} if live else {"availableNow": True}
    with small_row_groups(spark):
        return writer.trigger(**every).start()


def source_limits(rate: Rate | None) -> dict:
    """What a source is to be told of a rate."""
    if rate is None:
        return {}
    return {"max_records": rate.records, **({"least": rate.least, "delay": rate.delay} if rate.least else {})}


def start_routing(
    messages: DataFrame,
    sink: Topics,
    checkpoint: str,
    *,
    partitions: int = DEFAULT_PARTITIONS,
    subscriptions: Subscriptions | None = None,
    dead_letter_topic: str | None = DEAD_LETTERS,
    live: bool = False,
    rate: Rate | None = None,
) -> StreamingQuery:
    """Exchange messages (``value``, ``offset``) to the raw topics, all in one query.

    Messages that should have had a topic go to ``dead_letter_topic`` in the same pass, as
    they came and with the reason as their key; null drops them. Acknowledgements and
    unknown events are no loss and are dropped, as is what nobody subscribed to.
    """
    routed = route_raw(messages, partitions, carry=("offset",))
    accepted = F.col(REASON).isNull()
    if subscriptions:
        accepted = accepted & is_subscribed(subscriptions)
    lost = F.coalesce(~F.col(REASON).isin(*NO_LOSS), F.lit(False)) if dead_letter_topic else F.lit(False)
    records = routed.filter(accepted | lost).select(
        F.coalesce("topic", F.lit(dead_letter_topic)).alias("topic"),
        F.col(REASON).alias("key"),
        F.coalesce("partition", F.lit(0)).alias("partition"),
        "value",
        "offset",
    )
    return _start(messages.sparkSession, sink.writer(records), sink.sink_folder(), checkpoint, "route", live, rate)


def start_transform(
    spark: SparkSession,
    endpoint: str,
    source: Topics,
    sink: Topics,
    checkpoint: str,
    *,
    live: bool = False,
    rate: Rate | None = None,
) -> StreamingQuery:
    """A kind's raw topic to its processed topic; the source partition is kept."""
    kind = kind_of(endpoint)
    raw = source.read_stream(spark, kind.raw_topic, **source_limits(rate))
    rows = normalize(raw, kind.name, carry=("partition", "offset", EVENT_MS))
    records = encode_processed(rows, kind.name, carry=("offset",))
    records = records.withColumn("topic", F.lit(kind.processed_topic))
    writer = sink.writer(records, kind.processed_topic)
    folder = sink.sink_folder(kind.processed_topic)
    return _start(spark, writer, folder, checkpoint, f"transform-{kind.name}", live, rate)


def _table_writer(rows: DataFrame, endpoint: str, path: str, metrics: bool) -> DataStreamWriter:
    stored = table_rows(rows, endpoint)
    return (
        (observed(stored, endpoint) if metrics else stored)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .partitionBy(*partition_columns(endpoint))
    )


def start_load(
    spark: SparkSession,
    endpoint: str,
    source: Topics,
    path: str,
    checkpoint: str,
    *,
    live: bool = False,
    rate: Rate | None = None,
    metrics: bool = False,
) -> StreamingQuery:
    """A kind's processed topic to its table, bad rows to the table's quarantine.

    With ``metrics`` its progress reports count what was stored and rejected. A write that fails is tried again by Spark and then fails the query; no batch is
    given up.
    """
    kind = kind_of(endpoint)
    records = source.read_stream(spark, kind.processed_topic, **source_limits(rate))
    rows = decode_processed(records, kind.name, carry=("partition", "offset", "value", EVENT_MS))
    writer = _table_writer(rows, kind.name, path, metrics)
    return _start(spark, writer, path, checkpoint, f"load-{kind.name}", live, rate)


def start_direct(
    spark: SparkSession,
    endpoint: str,
    source: Topics,
    path: str,
    checkpoint: str,
    *,
    live: bool = False,
    rate: Rate | None = None,
    metrics: bool = False,
) -> StreamingQuery:
    """A kind's raw topic straight to its table, without the JSON of the processed topic.

    With ``metrics`` its progress reports count what was stored and rejected.
    """
    kind = kind_of(endpoint)
    raw = source.read_stream(spark, kind.raw_topic, **source_limits(rate))
    rows = normalize(raw, kind.name, carry=("partition", "offset", "value", EVENT_MS))
    writer = _table_writer(rows, kind.name, path, metrics)
    return _start(spark, writer, path, checkpoint, f"direct-{kind.name}", live, rate)


@dataclass(frozen=True)
class Pipeline:
    """All jobs for a set of endpoints over one folder and one pair of topic stores.

    Tables are ``<root>/tables/<table>``; every job's checkpoint is below
    ``<root>/checkpoints``. Endpoints of one kind share their jobs. A table's folder
    belongs to one query, so a root is filled by ``load`` or by ``direct``, not both.
    """

    spark: SparkSession
    endpoints: Sequence[str]
    root: str
    raw: Topics
    processed: Topics
    live: bool = False
    rates: dict[str, Rate] = field(default_factory=dict)
    markets: Sequence[str] | None = None

    def table_path(self, endpoint: str) -> str:
        return f"{self.root}/tables/{kind_of(endpoint).table}"

    def _checkpoint(self, stage: str, name: str = "all") -> str:
        return f"{self.root}/checkpoints/{stage}/{name}"

    def route(self, messages: DataFrame, **options) -> StreamingQuery:
        """Only the pipeline's own endpoints, and markets if it has any, are routed."""
        own = Subscriptions.of_endpoints(self.endpoints)
        if self.markets is not None:
            own = Subscriptions.of(self.markets, self.endpoints)
        options = {"subscriptions": own, "live": self.live, **options}
        return start_routing(messages, self.raw, self._checkpoint("route"), **options)

    def starts(self, stage: str) -> dict[str, Callable[[], StreamingQuery]]:
        """By kind, what starts its job of a stage (``transform``, ``load`` or ``direct``)."""

        def start(kind: Kind) -> StreamingQuery:
            checkpoint, options = self._checkpoint(stage, kind.name), {"live": self.live, "rate": self.rates.get(kind.name)}
            if stage == "transform":
                return start_transform(self.spark, kind.name, self.raw, self.processed, checkpoint, **options)
            job, source = {"load": (start_load, self.processed), "direct": (start_direct, self.raw)}[stage]
            return job(self.spark, kind.name, source, self.table_path(kind.name), checkpoint, **options)

        return {kind.name: partial(start, kind) for kind in distinct_kinds(self.endpoints)}

    def _start_all(self, stage: str) -> list[StreamingQuery]:
        return [start() for start in self.starts(stage).values()]

    def transform(self) -> list[StreamingQuery]:
        return self._start_all("transform")

    def load(self) -> list[StreamingQuery]:
        return self._start_all("load")

    def direct(self) -> list[StreamingQuery]:
        return self._start_all("direct")

    def supervise(self, *stages: str, **options) -> dict[str, Outcome]:
        """Run the jobs of stages together, each started again by itself when it fails; by ``<stage>-<kind>``."""
        starts = {f"{stage}-{kind}": start for stage in stages for kind, start in self.starts(stage).items()}
        return supervise(starts, **options)

    def drain(self, messages: DataFrame, **options) -> None:
        """Run the three stages one after the other over what there is now."""
        self.route(messages, **options).awaitTermination()
        for stage in (self.transform, self.load):
            for query in stage():
                query.awaitTermination()


def await_any(spark: SparkSession) -> None:
    """Wait until any running query stops or fails (live pipelines)."""
    spark.streams.awaitAnyTermination()
