"""Message kinds, their wire fields and their table columns.

Each message kind is described once, in table column order. The three schemas the
operators need follow from that description:

* ``wire_ddl``  - what ``from_json`` reads, with the exchange's own field names;
* ``named_ddl`` - the same shape with unique column names, for a positional cast;
* ``table_schema`` - the typed table row.

Wire fields that no column is made from are left out, so they are never parsed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

# Logical column types. "millis" is epoch milliseconds on the wire and a
# whole-second timestamp in a table; "id" and "count" may not be negative in a table.
WIRE_TYPES = {
    "id": "bigint",
    "count": "bigint",
    "millis": "bigint",
    "price": "decimal(14,8)",
    "quantity": "decimal(18,8)",
    "day_volume": "decimal(20,8)",
    "percent": "decimal(7,3)",
    "flag": "boolean",
    "text": "string",
    "book": "array<array<decimal(18,8)>>",
}

# Extra column of stored updates: the event time in milliseconds, which the table's own
# whole-second timestamp has lost. It orders the updates of a candlestick.
EVENT_MS = "event_ms"

# Event type on the wire -> message kind.
EVENT_KINDS = {
    "aggTrade": "aggTrade",
    "trade": "trade",
    "kline": "kline",
    "24hrMiniTicker": "miniTicker",
    "24hrTicker": "ticker",
    "avgPrice": "avgPrice",
    "depthUpdate": "depth",
}

# Column, logical type, wire field (a dot means one level of nesting).
COLUMNS = {
    "aggTrade": """
        first_trade_id          id        f
        last_trade_id           id        l
        aggregate_trade_id      id        a
        timestamp_utc           millis    E
        symbol                  text      s
        price                   price     p
        quantity                quantity  q
        is_buyer_market_maker   flag      m
    """,
    "trade": """
        trade_id                id        t
        timestamp_utc           millis    E
        symbol                  text      s
        price                   price     p
        quantity                quantity  q
        is_buyer_market_maker   flag      m
    """,
    "kline": """
        first_trade_id                 id        k.f
        last_trade_id                  id        k.L
        timestamp_utc                  millis    E
        open_timestamp_utc             millis    k.t
        close_timestamp_utc            millis    k.T
        symbol                         text      s
        interval                       text      k.i
        num_trades                     count     k.n
        is_closed                      flag      k.x
        open_price                     price     k.o
        close_price                    price     k.c
        high_price                     price     k.h
        low_price                      price     k.l
        base_asset_volume              quantity  k.v
        quote_asset_volume             quantity  k.q
        taker_buy_base_asset_volume    quantity  k.V
        taker_buy_quote_asset_volume   quantity  k.Q
    """,
    "miniTicker": """
        timestamp_utc              millis      E
        symbol                     text        s
        open_price                 price       o
        close_price                price       c
        high_price                 price       h
        low_price                  price       l
        total_base_asset_volume    day_volume  v
        total_quote_asset_volume   day_volume  q
    """,
    "ticker": """
        first_trade_id             id          F
        last_trade_id              id          L
        timestamp_utc              millis      E
        open_timestamp_utc         millis      O
        close_timestamp_utc        millis      C
        symbol                     text        s
        price_change               price       p
        price_change_percent       percent     P
        weighted_avg_price         price       w
        num_trades                 count       n
        first_trade_price          price       x
        open_price                 price       o
        close_price                price       c
        high_price                 price       h
        low_price                  price       l
        best_bid_price             price       b
        best_bid_quantity          quantity    B
        best_ask_price             price       a
        best_ask_quantity          quantity    A
        last_quantity              quantity    Q
        total_base_asset_volume    day_volume  v
        total_quote_asset_volume   day_volume  q
    """,
    "avgPrice": """
        timestamp_utc              millis  E
        last_trade_timestamp_utc   millis  T
        symbol                     text    s
        avg_price_interval         text    i
        avg_price                  price   w
    """,
    "depth": """
        timestamp_utc     millis  E
        symbol            text    s
        first_update_id   id      U
        final_update_id   id      u
        bids              book    b
        asks              book    a
    """,
}

# Table sort keys.
SORT_KEYS = {
    "aggTrade": ("symbol", "timestamp_utc", "aggregate_trade_id"),
    "trade": ("symbol", "timestamp_utc", "trade_id"),
    "kline": ("symbol", "interval", "open_timestamp_utc"),
    "miniTicker": ("symbol", "timestamp_utc"),
    "ticker": ("symbol", "timestamp_utc"),
    "avgPrice": ("symbol", "timestamp_utc"),
    "depth": ("symbol", "timestamp_utc"),
}

# Levels kept per side of an order book.
BOOK_LEVELS = 5


@dataclass(frozen=True)
class Field:
    """One table column and the wire field it comes from."""

    name: str
    logical: str
    wire: str

    @property
    def wire_type(self) -> str:
        return WIRE_TYPES[self.logical]

    @property
    def table_type(self) -> str:
        return "timestamp" if self.logical == "millis" else self.wire_type

    @property
    def non_negative(self) -> bool:
        return self.logical in ("id", "count")


@dataclass(frozen=True)
class Kind:
    """One message kind: its fields in table order and its table."""

    name: str
    fields: tuple[Field, ...]
    sort_key: tuple[str, ...]

    @property
    def table(self) -> str:
        return self.name + "s"

    @property
    def raw_topic(self) -> str:
        return self.name + "_raw"

    @property
    def processed_topic(self) -> str:
        return self.name + "_processed"

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def nested(self) -> str | None:
        """Name of the wire field that holds the nested bar, if there is one."""
        parents = {f.wire.split(".")[0] for f in self.fields if "." in f.wire}
        return parents.pop() if parents else None

    @property
    def date_source(self) -> str:
        """Timestamp the table's date partition is made from. Every version of a
        candlestick has to land in one partition, so those go by opening time."""
        return "open_timestamp_utc" if self.name == "kline" else "timestamp_utc"

    @property
    def date_column(self) -> str:
        return "open_date" if self.name == "kline" else "event_date"

    @property
    def magnitudes(self) -> tuple[str, ...]:
        """Ids sent as -1 when a bar holds no trades; tables keep the absolute value."""
        return ("first_trade_id", "last_trade_id") if self.name == "kline" else ()

    @property
    def books(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.logical == "book")

    def _struct_ddl(self, top, inner) -> str:
        parts = [top(f) for f in self.fields if "." not in f.wire]
        if self.nested:
            members = ",".join(inner(f) for f in self.fields if "." in f.wire)
            parts.append(f"`{self.nested}`:struct<{members}>")
        return "struct<" + ",".join(parts) + ">"

    @cached_property
    def wire_ddl(self) -> str:
        def field(f):
            return f"`{f.wire.split('.')[-1]}`:{f.wire_type}"

        return self._struct_ddl(field, field)

    @cached_property
    def named_ddl(self) -> str:
        def field(f):
            return f"`{f.name}`:{f.wire_type}"

        return self._struct_ddl(field, field)

    @cached_property
    def table_ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.table_type}" for f in self.fields)

    @cached_property
    def table_schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.table_ddl)


KINDS: dict[str, Kind] = {
    name: Kind(
        name,
        tuple(Field(*line.split()) for line in text.strip().splitlines()),
        SORT_KEYS[name],
    )
    for name, text in COLUMNS.items()
}


def kind_of(endpoint: str) -> Kind:
    """Message kind of an endpoint or topic name: ``kline_3m`` and ``kline_raw`` are ``kline``."""
    return KINDS[endpoint.split("_")[0]]


def distinct_kinds(endpoints: Iterable[str]) -> list[Kind]:
    """Message kinds behind the configured endpoints, each once, in first-seen order."""
    return list(dict.fromkeys(kind_of(e) for e in endpoints))
