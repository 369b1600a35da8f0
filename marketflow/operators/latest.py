"""Keep-latest over candlestick updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.schemas import EVENT_MS, KINDS

# Offsets only compare within one topic partition, so they come last.
VERSION = (EVENT_MS, "partition", "offset")


def latest_klines(updates: DataFrame, order: Sequence[str] = VERSION) -> DataFrame:
    """The last update of every candlestick: one row per symbol, interval and opening time.

    The version is the event time in milliseconds. Routing spreads a candlestick's updates
    over topic partitions by that time, so updates of one millisecond share a partition and
    the one read last from it wins. Spark cuts every map task's rows to one per key before
    the exchange (WindowGroupLimit), so a candlestick with many updates, or a symbol with
    most of them, does not skew it.
    """
    newest = Window.partitionBy(*KINDS["kline"].sort_key).orderBy(*(F.desc(c) for c in order))
    return updates.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
