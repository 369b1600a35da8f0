"""Which markets and endpoints are wanted."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Subscriptions:
    """Every combination of the listed markets and endpoints; ``markets`` null takes all markets.

    Markets go by lower case, blanks are skipped and an empty list is an error.
    """

    markets: tuple[str, ...] | None
    endpoints: tuple[str, ...]

    @classmethod
    def of(cls, markets: Iterable[str], endpoints: Iterable[str]) -> Subscriptions:
        listed = tuple(m.lower() for m in markets or () if m)
        if not listed:
            raise ValueError("no markets are given")
        return cls(listed, cls.of_endpoints(endpoints).endpoints)

    @classmethod
    def of_endpoints(cls, endpoints: Iterable[str]) -> Subscriptions:
        wanted = tuple(e for e in endpoints or () if e)
        if not wanted:
            raise ValueError("no endpoints are given")
        return cls(None, wanted)


def subscription_pairs(markets: DataFrame, endpoints: Iterable[str]) -> DataFrame:
    """``market@endpoint`` for every row of ``markets`` (column ``market``) and every endpoint."""
    wanted = [e for e in endpoints if e]
    if not wanted:
        raise ValueError("no endpoints are given")
    listed = markets.filter(F.col("market") != "").select(F.lower("market").alias("market"))
    pairs = listed.select("market", F.explode(F.array(*map(F.lit, wanted))).alias("endpoint"))
    return pairs.select("market", "endpoint", F.concat_ws("@", "market", "endpoint").alias("subscription"))


def stream_name(endpoint: Column, interval: Column) -> Column:
    """``kline`` and ``3m`` -> ``kline_3m``; without an interval just the endpoint."""
    return F.concat_ws("_", endpoint, interval)


def is_subscribed(subscriptions: Subscriptions) -> Column:
    """Whether a routed message's market and endpoint are both subscribed (never null).

    The subscribed pairs are all combinations of two lists, so membership of a pair is
    membership in each list: two hash-set lookups per row and no join, however long the
    lists are. An endpoint without an interval takes candlesticks of every interval.
    """
    endpoints = sorted(set(subscriptions.endpoints))
    wanted = stream_name(F.col("endpoint"), F.col("interval")).isin(*endpoints) | F.col("endpoint").isin(*endpoints)
    if subscriptions.markets is not None:
        wanted = wanted & F.lower("symbol").isin(*sorted(set(subscriptions.markets)))
    return F.coalesce(wanted, F.lit(False))


def filter_subscribed(messages: DataFrame, subscriptions: Subscriptions) -> DataFrame:
    """Keep messages whose market and endpoint are both subscribed."""
    return messages.filter(is_subscribed(subscriptions))
