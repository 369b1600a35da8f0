"""Exchange messages made from the test tables.

Each function turns rows of one table into raw messages (``value``, ``partition``,
``offset``), in batch or streaming. Prices and quantities are sent as JSON strings, as
exchanges do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions import topic_partition
from marketflow.operators.route import DEFAULT_PARTITIONS

# The tables store UTC wall-clock times; read as instants they do not depend on the session zone.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    "part": "p_partkey bigint, p_brand string, p_retailprice double, p_size int",
}

HOUR_MS = 3_600_000


def read_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def stream_rows(spark: SparkSession, sf_dir: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS[table])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A file source takes folders and globs; the glob also fits a table that is one file.
    return reader.parquet(f"{sf_dir}/{table}.parquet*")


def amount(value: Column | str | int | float, scale: int = 8) -> Column:
    """A number as a fixed-point value, to be sent as text."""
    column = F.lit(value) if isinstance(value, (int, float)) else F.col(value) if isinstance(value, str) else value
    return column.cast(f"decimal(20,{scale})")


def plain_text(number: Column, scale: int) -> Column:
    """A decimal in plain digits; outside ANSI mode a cast writes those below 1E-6 with an exponent.

    A cast takes a fraction of the time of ``format_number``, which is left with those few.
    """
    digits = number.cast("string")
    return F.when(~F.contains(digits, F.lit("E")), digits).otherwise(
        F.call_function("format_number", number, F.lit("0." + "0" * scale))
    )


def text(value: Column | str | int | float, scale: int = 8) -> Column:
    return plain_text(amount(value, scale), scale)


def message(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*(column.alias(name) for name, column in fields.items())))


def records(rows: DataFrame, value: Column, offset: Column, event_time: Column) -> DataFrame:
    return rows.select(
        value.cast("binary").alias("value"),
        topic_partition(event_time, DEFAULT_PARTITIONS).alias("partition"),
        offset.alias("offset"),
    )


def trade_fields() -> dict[str, Column]:
    ms = F.unix_millis("ts")
    return {
        "e": F.lit("trade"),
        "E": ms,
        "s": F.upper("event_type"),
        "t": F.col("event_id"),
        "p": text("value"),
        "q": text(F.get_json_object("props", "$.k")),
        "T": ms,
        "m": F.col("event_id") % 2 == 0,
        "M": F.lit(True),
    }


def trades(events: DataFrame) -> DataFrame:
    return records(events, message(trade_fields()), F.col("event_id"), F.unix_millis("ts"))


def agg_trades(lineitem: DataFrame) -> DataFrame:
    ms = F.unix_millis("l_shipdate")
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    fields = {
        "e": F.lit("aggTrade"),
        "E": ms,
        "s": F.concat("l_returnflag", "l_linestatus"),
        "a": number,
        "p": text("l_extendedprice"),
        "q": text("l_quantity"),
        "f": F.col("l_orderkey"),
        "l": F.col("l_orderkey") + F.col("l_linenumber"),
        "T": ms,
        "m": F.col("l_linenumber") % 2 == 0,
        "M": F.lit(True),
    }
    return records(lineitem, message(fields), number, ms)


def kline_fields() -> dict[str, Column]:
    """One candlestick update per event, of the hour it falls in."""
    ms = F.unix_millis("ts")
    opened = ms - ms % HOUR_MS
    event_id, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("bigint")
    empty = event_id % 50 == 0
    symbol = F.upper("event_type")
    price = amount("value")
    bar = F.struct(
        opened.alias("t"),
        (opened + (HOUR_MS - 1)).alias("T"),
        symbol.alias("s"),
        F.lit("1h").alias("i"),
        F.when(empty, F.lit(-1)).otherwise(event_id).alias("f"),
        F.when(empty, F.lit(-1)).otherwise(event_id + k).alias("L"),
        text(price).alias("o"),
        text(price + 1).alias("c"),
        text(price + 2).alias("h"),
        text(price - amount(0.01)).alias("l"),
        text(k).alias("v"),
        k.alias("n"),
        (event_id % 2 == 1).alias("x"),
        text(k * 2).alias("q"),
        text(k * 3).alias("V"),
        text(k * 4).alias("Q"),
        F.lit("0").alias("B"),
    )
    return {"e": F.lit("kline"), "E": ms, "s": symbol, "k": bar}


def klines(events: DataFrame) -> DataFrame:
    return records(events, message(kline_fields()), F.col("event_id"), F.unix_millis("ts"))


def mini_tickers(orders: DataFrame) -> DataFrame:
    ms = F.unix_millis("o_orderdate")
    price = amount("o_totalprice")
    fields = {
        "e": F.lit("24hrMiniTicker"),
        "E": ms,
        "s": F.col("o_orderstatus"),
        "c": text(price + 1),
        "o": text(price),
        "h": text(price + 2),
        "l": text(price - 1),
        "v": text(F.col("o_orderkey") * 1000),
        "q": text(F.col("o_custkey") * 1000),
    }
    return records(orders, message(fields), F.col("o_orderkey"), ms)


def tickers(orders: DataFrame) -> DataFrame:
    ms = F.unix_millis("o_orderdate")
    key, price = F.col("o_orderkey"), amount("o_totalprice")
    fields = {
        "e": F.lit("24hrTicker"),
        "E": ms,
        "s": F.col("o_orderstatus"),
        "p": text(price - 250_000),
        "P": text((key % 200_000 - 100_000) * F.lit("0.001").cast("decimal(4,3)"), 3),
        "w": text(price),
        "x": text(price - 2),
        "c": text(price + 1),
        "Q": text(key % 1000),
        "b": text(price - 3),
        "B": text(key % 100),
        "a": text(price + 3),
        "A": text(key % 10),
        "o": text(price),
        "h": text(price + 2),
        "l": text(price - 1),
        "v": text(key * 1000),
        "q": text(F.col("o_custkey") * 1000),
        "O": ms - 86_400_000,
        "C": ms - 1,
        "F": key,
        "L": key + 7,
        "n": F.lit(8),
    }
    return records(orders, message(fields), key, ms)


def avg_prices(part: DataFrame) -> DataFrame:
    ms = F.lit(1_700_000_000_123) + F.col("p_partkey") * 1000
    fields = {
        "e": F.lit("avgPrice"),
        "E": ms,
        "s": F.col("p_brand"),
        "i": F.lit("5m"),
        "w": text("p_retailprice"),
        "T": ms - 7,
    }
    return records(part, message(fields), F.col("p_partkey"), ms)


def depth_fields() -> dict[str, Column]:
    """A book of one to eight levels per side."""
    event_id, price = F.col("event_id"), amount("value")

    def side(offset: float) -> Column:
        levels = F.sequence(F.lit(0), (event_id % 8).cast("int"))
        return F.transform(levels, lambda i: F.array(text(price + i + amount(offset)), text(i)))

    return {
        "e": F.lit("depthUpdate"),
        "E": F.unix_millis("ts"),
        "s": F.upper("event_type"),
        "U": event_id,
        "u": event_id + 2,
        "b": side(0),
        "a": side(0.25),
    }


def depths(events: DataFrame) -> DataFrame:
    return records(events, message(depth_fields()), F.col("event_id"), F.unix_millis("ts"))


def mixed(events: DataFrame) -> DataFrame:
    """A trade, a candlestick update and a book of every event, on one stream."""
    kinds = F.array(*(message(f) for f in (trade_fields(), kline_fields(), depth_fields())))
    rows = events.select("event_id", "ts", F.explode(kinds).alias("message"))
    return records(rows, F.col("message"), F.col("event_id"), F.unix_millis("ts"))


def disturbed_trades(events: DataFrame) -> DataFrame:
    """Trades among acknowledgements, unknown events and broken messages; first match wins."""
    event_id = F.col("event_id")
    fields = trade_fields()
    without_time = {name: column for name, column in fields.items() if name != "E"}
    whole = message(fields)
    value = (
        F.when(event_id % 97 == 0, F.concat(F.lit('{"result":null,"id":'), event_id.cast("string"), F.lit("}")))
        .when(event_id % 89 == 0, message({**fields, "e": F.lit("bookTicker")}))
        .when(event_id % 83 == 0, message(without_time))
        .when(event_id % 79 == 0, F.concat(F.lit("not json "), event_id.cast("string")))
        .when(event_id % 73 == 0, message({**fields, "E": fields["E"].cast("string")}))
        .when(event_id % 71 == 0, F.concat(F.lit("["), whole, F.lit("]")))
        .when(event_id % 67 == 0, F.concat(whole, F.lit(" trailing")))
        .otherwise(whole)
    )
    return events.select(value.cast("binary").alias("value"), event_id.alias("offset"))


def repeated_keys(events: DataFrame) -> DataFrame:
    """Trades, candlesticks and books with keys sent twice, and some that are broken besides.

    The event type, the symbol, the event time or a candlestick's interval comes a second time; the
    values sent first are wrong.
    """
    event_id = F.col("event_id")
    kinds = F.array(*(message(f) for f in (trade_fields(), kline_fields(), depth_fields())))
    whole = F.get(kinds, (event_id % 3).cast("int"))
    body = F.substr(whole, F.lit(2))
    wrong = F.concat(F.lit('{"s":"WRONG","e":"bookTicker","E":"soon",'), body)
    value = (
        F.when(event_id % 41 == 0, F.concat(wrong, F.lit(" trailing")))
        .when(event_id % 37 == 0, F.concat(wrong, F.lit("]")))
        .when(event_id % 31 == 0, F.concat(F.lit("["), wrong, F.lit("]")))
        .when(event_id % 29 == 0, F.regexp_replace(whole, F.lit(r"\}$"), F.lit(',"e":"bookTicker"}')))
        .when(event_id % 23 == 0, F.regexp_replace(whole, F.lit(r"\}$"), F.lit(',"E":"later"}')))
        .when(event_id % 2 == 0, F.replace(wrong, F.lit('"k":{'), F.lit('"k":{"i":"3m","n":-5,')))
        .otherwise(whole)
    )
    return records(events, value, event_id, F.unix_millis("ts"))


def faulty_trades(events: DataFrame) -> DataFrame:
    """Well-formed trade messages, some with fields no table row can be made of."""
    event_id = F.col("event_id")
    fields = trade_fields()
    fields["p"] = F.when(event_id % 97 == 0, F.lit(None)).when(event_id % 89 == 0, F.lit("12345678.1")).otherwise(
        fields["p"]
    )
    fields["t"] = F.when(event_id % 83 == 0, -event_id - 1).otherwise(fields["t"])
    fields["q"] = F.when(event_id % 79 == 0, F.lit("many")).otherwise(fields["q"])
    fields["E"] = F.when(event_id % 73 == 0, F.lit(9_000_000_000_000_000_000)).otherwise(fields["E"])
    value = F.when(event_id % 71 == 0, F.lit("{broken")).otherwise(message(fields))
    return records(events, value, event_id, F.unix_millis("ts"))
