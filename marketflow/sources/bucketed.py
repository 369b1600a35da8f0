"""Candlesticks in a catalog table that is bucketed by their key.

All updates of a candlestick lie in one bucket, so keep-latest over the whole table needs no
shuffle, however often it is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions import utc_date
from marketflow.operators.latest import VERSION, latest_klines
from marketflow.schemas import KINDS

KLINE = KINDS["kline"]


def create_bucketed_klines(spark: SparkSession, table: str, buckets: int) -> None:
    """Create the table unless it is there; ``buckets`` suits the whole table, a date has as many files.

    A bucket of all dates is one task of a read, so there should be enough for buckets of
    some hundred megabytes.
    """
    key = ", ".join(f"`{c}`" for c in KLINE.sort_key)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({KLINE.table_ddl}, event_ms bigint, `partition` int, `offset` bigint, "
        f"`{KLINE.date_column}` date) USING parquet PARTITIONED BY (`{KLINE.date_column}`) "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    )


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    if described is None:
        raise ValueError(f"{table} is not bucketed")
    return int(described["data_type"])


def insert_bucketed(updates: DataFrame, table: str) -> None:
    """Append a batch of updates (table columns and ``VERSION``), one row per candlestick.

    Each map task keeps its last update of a candlestick before the shuffle, so that one with
    most of the batch's updates does not make a large task. The shuffle is the buckets' own, so
    a batch adds one file per bucket and date.
    """
    spark = updates.sparkSession
    dated = F.expr(utc_date(KLINE.date_source)).alias(KLINE.date_column)
    latest = latest_klines(updates).select(*KLINE.columns, *VERSION, dated)
    dealt = latest.repartition(bucket_count(spark, table), *KLINE.sort_key)
    dealt.sortWithinPartitions(KLINE.date_column, *KLINE.sort_key).write.insertInto(table)


def read_bucketed(spark: SparkSession, table: str, *, start: str | None = None, end: str | None = None) -> DataFrame:
    """The last update of every candlestick, in table column order; nothing is shuffled.

    ``start`` (inclusive) and ``end`` (exclusive) are UTC dates of opening.
    """
    rows = spark.table(table)
    if start:
        rows = rows.filter(F.col(KLINE.date_column) >= F.lit(start).cast("date"))
    if end:
        rows = rows.filter(F.col(KLINE.date_column) < F.lit(end).cast("date"))
    return latest_klines(rows).select(*KLINE.columns)
