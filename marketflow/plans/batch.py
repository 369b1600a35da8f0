"""Stored messages to tables in batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from marketflow.operators import decode_processed, normalize, valid_rows, validate
from marketflow.schemas import EVENT_MS, kind_of
from marketflow.sources.tables import append_rows
from marketflow.sources.numbered import NumberedTopics
from marketflow.sources.topics import FileTopics, KafkaTopics, Offsets

# What a table folder keeps besides the table's columns.
STORED = ("partition", "offset", "value", EVENT_MS)


def raw_to_rows(raw: DataFrame, endpoint: str, *extra: str) -> DataFrame:
    """Table rows of one kind's raw messages, in table column order, then ``extra`` columns."""
    rows = normalize(raw, endpoint, carry=extra)
    return valid_rows(validate(rows, endpoint), endpoint, *extra)


def backfill(
    spark: SparkSession,
    endpoint: str,
    source: FileTopics | KafkaTopics | NumberedTopics,
    path: str,
    *,
    start: Offsets | None = None,
    end: Offsets | None = None,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    processed: bool = False,
) -> None:
    """Append a kind's raw or processed topic, or a range of it, to its table.

    A range goes by offsets (one for all partitions, or one each) or by record time; its start
    is read and its end is not. What the table holds already is skipped by topic partition
    and offset, so a backfill may be run again, or again over a longer range.
    """
    kind = kind_of(endpoint)
    topic = kind.processed_topic if processed else kind.raw_topic
    records = source.read(spark, topic, start, end, since=since, until=until)
    read = decode_processed if processed else normalize
    append_rows(read(records, endpoint, carry=STORED), endpoint, path, skip_stored=True)
