"""Keep-latest as a running aggregation: the last update of every candlestick, kept as state.

Every micro-batch hands on the candlesticks that it changed, one row each, and ``write_updates``
puts them into a folder of the batch's own number. The state holds one row per candlestick seen;
with a watermark it lets go of those that opened longer ago than its delay, and updates that come
for them afterwards are dropped, as Spark's progress reports tell. A log of all updates, filled
beside it, still has them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketflow.functions import utc_date
from marketflow.operators import latest_klines, normalize, valid_rows, validate
from marketflow.operators.latest import VERSION
from marketflow.schemas import KINDS
from marketflow.sources.topics import FileTopics, KafkaTopics, Rate
from marketflow.sources.work import claim_stream_folder
from marketflow.streaming.jobs import source_limits

KLINE = KINDS["kline"]
BATCH = "batch"
_STORED = f"{KLINE.table_ddl}, event_ms bigint, `partition` int, `offset` bigint, {BATCH} bigint, {KLINE.date_column} date"


def running_latest(updates: DataFrame, watermark: str | None = None) -> DataFrame:
    """The last update of every candlestick of a stream of updates (table columns and ``VERSION``).

    ``watermark`` is a delay on the opening time, ``"2 days"`` for instance; it should be longer
    than the longest interval and than any update comes late. Rows count in map tasks before
    they are shuffled by candlestick, so one with many updates does not skew a task.
    """
    if watermark:
        updates = updates.withWatermark("open_timestamp_utc", watermark)
    key = KLINE.sort_key
    others = [c for c in KLINE.columns if c not in key]
    newest = F.max(F.struct(*VERSION, *others)).alias("last")
    return updates.groupBy(*key).agg(newest).select(*key, "last.*").select(*KLINE.columns, *VERSION)


def write_updates(rows: DataFrame, batch: int, path: str) -> None:
    """Write a micro-batch's candlesticks to its own folder; a batch that is there whole stays as it is."""
    folder = f"{path}/{BATCH}={batch}"
    try:
        rows.sparkSession.read.text(f"{folder}/_SUCCESS")
    except AnalysisException:
        dated = rows.select("*", F.expr(utc_date(KLINE.date_source)).alias(KLINE.date_column))
        dated.write.mode("overwrite").partitionBy(KLINE.date_column).parquet(folder)


def start_latest(
    spark: SparkSession,
    source: KafkaTopics | FileTopics,
    path: str,
    checkpoint: str,
    *,
    watermark: str | None = None,
    live: bool = False,
    rate: Rate | None = None,
) -> StreamingQuery:
    """The raw candlestick topic to a folder of last updates, with the last updates as state.

    Without a watermark the state grows by a row per candlestick for ever. The number of state
    partitions is that of shuffle partitions when the checkpoint is made.
    """
    claim_stream_folder(spark, path, checkpoint)
    raw = source.read_stream(spark, KLINE.raw_topic, **source_limits(rate))
    rows = valid_rows(validate(normalize(raw, "kline", carry=VERSION), "kline"), "kline", *VERSION)
    writer = (
        running_latest(rows, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: write_updates(batch, number, path))
        .option("checkpointLocation", checkpoint)
        .queryName(f"latest {checkpoint}")
    )
    if not live:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=rate.interval if rate else "0 seconds").start()


def read_latest(spark: SparkSession, path: str, *, start: str | None = None, end: str | None = None) -> DataFrame:
    """The last update of every candlestick that ``start_latest`` wrote, in table column order.

    ``start`` (inclusive) and ``end`` (exclusive) are UTC dates of opening; they prune folders.
    """
    rows = spark.read.schema(T.StructType.fromDDL(_STORED)).parquet(path)
    if start:
        rows = rows.filter(F.col(KLINE.date_column) >= F.lit(start).cast("date"))
    if end:
        rows = rows.filter(F.col(KLINE.date_column) < F.lit(end).cast("date"))
    return latest_klines(rows).select(*KLINE.columns)
