"""Hand-written messages through parsing, routing and validation."""

from __future__ import annotations

import datetime as dt
import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketflow import (
    KINDS,
    decode_processed,
    distinct_kinds,
    encode_processed,
    normalize,
    quarantined_rows,
    route_raw,
    routed_messages,
    split_valid,
    validate,
)

T0 = 1_700_000_000_123
AT = dt.datetime(2023, 11, 14, 22, 13, 20)

TRADE = {"e": "trade", "E": T0, "s": "BTCUSDT", "t": 1, "p": "6.55000000", "q": "2", "T": T0 - 3, "m": True, "M": True}
AGG_TRADE = {
    "e": "aggTrade", "E": T0, "s": "BTCUSDT", "a": 9, "p": "1.5", "q": "2", "f": 3, "l": 4, "T": T0, "m": False, "M": True,
}
KLINE = {
    "e": "kline", "E": T0, "s": "BTCUSDT",
    "k": {
        "t": T0 - 123, "T": T0 + 179_876, "s": "BTCUSDT", "i": "3m", "f": -1, "L": -1, "o": "1", "c": "2", "h": "3",
        "l": "0.5", "v": "10", "n": 0, "x": False, "q": "20", "V": "5", "Q": "6", "B": "0",
    },
}
MINI_TICKER = {"e": "24hrMiniTicker", "E": T0, "s": "ETHUSDT", "c": "2", "o": "1", "h": "3", "l": "0.5", "v": "7", "q": "8"}
TICKER = {
    "e": "24hrTicker", "E": T0, "s": "ETHUSDT", "p": "-1.5", "P": "-1.23456", "w": "1", "x": "2", "c": "3", "Q": "4",
    "b": "5", "B": "6", "a": "7", "A": "8", "o": "9", "h": "10", "l": "11", "v": "12", "q": "13", "O": T0 - 86_400_000,
    "C": T0 - 1, "F": 14, "L": 15, "n": 16,
}
AVG_PRICE = {"e": "avgPrice", "E": T0, "s": "ETHUSDT", "i": "5m", "w": "25.5", "T": T0 - 7}
DEPTH = {
    "e": "depthUpdate", "E": T0, "s": "BTCUSDT", "U": 1, "u": 3,
    "b": [[str(9 - i), str(i)] for i in range(7)], "a": [],
}
ALL = {
    "aggTrade": AGG_TRADE, "trade": TRADE, "kline": KLINE, "miniTicker": MINI_TICKER, "ticker": TICKER,
    "avgPrice": AVG_PRICE, "depth": DEPTH,
}


def raw(spark, *messages):
    rows = [
        (m if m is None or isinstance(m, str) else json.dumps(m), 4, i) for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, "value string, partition int, offset bigint")


def one(spark, endpoint, message):
    (row,) = normalize(raw(spark, message), endpoint).collect()
    return row.asDict()


def reasons(spark, endpoint, *messages):
    rows = normalize(raw(spark, *messages), endpoint, carry=("offset",))
    checked = validate(rows, endpoint)
    return [r.reject_reason for r in checked.orderBy("offset").collect()]


def routes(spark, *messages, **options):
    routed = route_raw(raw(spark, *messages), carry=("offset",), **options)
    return routed.orderBy("offset").collect()


@pytest.fixture(params=["true", "false"])
def case_sensitive(spark, request):
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", request.param)
    yield
    spark.conf.set("spark.sql.caseSensitive", before)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_kind_has_its_columns_in_order(spark):
    expected = {"aggTrade": 8, "trade": 6, "kline": 17, "miniTicker": 8, "ticker": 22, "avgPrice": 5, "depth": 6}
    assert {k: len(v.columns) for k, v in KINDS.items()} == expected
    for name, message in ALL.items():
        frame = normalize(raw(spark, message), name)
        assert frame.columns == [*KINDS[name].columns, "partition"]
        assert frame.drop("partition").schema.simpleString() == KINDS[name].table_schema.simpleString()


@pytest.mark.parametrize("name", sorted(ALL))
def test_complete_messages_are_valid(spark, case_sensitive, name):
    assert reasons(spark, name, ALL[name]) == [None]


def test_trade_values(spark, case_sensitive):
    assert one(spark, "trade_raw", TRADE) == {
        "trade_id": 1, "timestamp_utc": AT, "symbol": "BTCUSDT", "price": Decimal("6.55000000"),
        "quantity": Decimal("2.00000000"), "is_buyer_market_maker": True, "partition": 4,
    }


def test_kline_values(spark, case_sensitive):
    row = one(spark, "kline_3m", KLINE)
    assert (row["first_trade_id"], row["last_trade_id"], row["interval"], row["num_trades"]) == (-1, -1, "3m", 0)
    assert row["open_timestamp_utc"] == AT and row["close_timestamp_utc"] == AT + dt.timedelta(seconds=179)
    assert (row["low_price"], row["last_trade_id"]) == (Decimal("0.50000000"), -1)
    assert (row["base_asset_volume"], row["taker_buy_base_asset_volume"]) == (Decimal(10), Decimal(5))
    assert (row["quote_asset_volume"], row["taker_buy_quote_asset_volume"]) == (Decimal(20), Decimal(6))


def test_ticker_values(spark, case_sensitive):
    row = one(spark, "ticker", TICKER)
    names = list(KINDS["ticker"].columns)
    assert [row[c] for c in names[:2]] == [14, 15]
    assert [row[c] for c in names[6:]] == [
        Decimal("-1.5"), Decimal("-1.235"), Decimal(1), 16, *map(Decimal, (2, 9, 3, 10, 11, 5, 6, 7, 8, 4, 12, 13)),
    ]


def test_kline_ids_become_magnitudes(spark):
    bar = {**KLINE["k"], "f": -(2**63), "L": -7}
    valid, _ = split_valid(normalize(raw(spark, KLINE), "kline"), "kline")
    assert valid.select("first_trade_id", "last_trade_id").collect() == [(1, 1)]
    assert reasons(spark, "kline", {**KLINE, "k": bar}) == ["missing first_trade_id"]


def test_negative_ids_are_quarantined_but_for_klines(spark):
    assert reasons(spark, "ticker", {**TICKER, "F": -1, "L": -1}) == [
        "negative first_trade_id, negative last_trade_id"
    ]


def test_books_keep_five_levels_in_order(spark):
    row = one(spark, "depth", DEPTH)
    assert [pair[0] for pair in row["bids"]] == [Decimal(9 - i) for i in range(5)]
    assert row["asks"] == []
    exact = {**DEPTH, "b": DEPTH["b"][:5], "a": DEPTH["b"][:6]}
    row = one(spark, "depth", exact)
    assert len(row["bids"]) == len(row["asks"]) == 5


def test_books_with_nulls_are_quarantined(spark):
    assert reasons(
        spark, "depth",
        {**DEPTH, "b": [["1", None]]}, {**DEPTH, "a": [None]}, {**DEPTH, "a": [["x", "1"]]}, {**DEPTH, "a": [[]]},
        {**DEPTH, "b": DEPTH["b"][:5] + [[None, None]]},
    ) == ["incomplete bids", "incomplete asks", "missing asks", None, None]


PRICES = [
    ("1.123456785", "1.12345679"),
    ("12345678.1", None),
    (1.5, "1.5"),
    ("", None),
    ("x", None),
    ("1e-9", "0"),
    (None, None),
]


def test_prices(spark):
    rows = normalize(raw(spark, *({**TRADE, "p": p} for p, _ in PRICES)), "trade", carry=("offset",))
    got = [r.price for r in rows.orderBy("offset").collect()]
    assert got == [None if expected is None else Decimal(expected) for _, expected in PRICES]


def test_long_decimals_stay_exact(spark):
    text = json.dumps(MINI_TICKER).replace('"v": "7"', '"v": 123456789012.12345678')
    row = one(spark, "miniTicker", text)
    assert row["total_base_asset_volume"] == Decimal("123456789012.12345678")


def test_quoted_longs_and_flags_do_not_parse(spark):
    assert reasons(spark, "trade", {**TRADE, "t": "1", "m": "true"}) == ["missing trade_id, missing is_buyer_market_maker"]
    assert reasons(spark, "trade", json.dumps(TRADE).replace('"t": 1', '"t": 1.0')) == ["missing trade_id"]


def test_broken_messages_lose_every_column(spark):
    every = ", ".join(f"missing {c}" for c in KINDS["trade"].columns)
    assert reasons(spark, "trade", "junk", None, "", json.dumps(TRADE)[:-1]) == [every] * 4
    assert reasons(spark, "kline", {**KLINE, "k": None})[0].startswith("missing first_trade_id, missing last_trade_id")


INSTANTS = [
    (T0, AT),
    (-1500, dt.datetime(1969, 12, 31, 23, 59, 59)),
    (-1, dt.datetime(1970, 1, 1)),
    (253_402_300_799_999, dt.datetime(9999, 12, 31, 23, 59, 59)),
    (253_402_300_800_000, None),
    (2**63 - 1, None),
    (-(2**63), None),
]


def test_instants(spark):
    rows = normalize(raw(spark, *({**TRADE, "E": ms} for ms, _ in INSTANTS)), "trade", carry=("offset",))
    got = [r[0] for r in rows.orderBy("offset").select(F.unix_seconds("timestamp_utc")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    assert got == [None if at is None else int((at - epoch).total_seconds()) for _, at in INSTANTS]


def test_repeated_hour_stays_apart(spark, zone):
    """2023-11-05 05:30Z and 06:30Z are both 01:30 in New York."""
    first = 1_699_162_200_000
    rows = normalize(raw(spark, {**TRADE, "E": first}, {**TRADE, "E": first + 3_600_000}), "trade")
    assert [r[0] for r in rows.select(F.unix_seconds("timestamp_utc")).collect()] == [first // 1000, first // 1000 + 3600]


@pytest.mark.parametrize("name", sorted(ALL))
def test_processed_json_round_trips(spark, zone, name):
    rows = normalize(raw(spark, ALL[name]), name)
    encoded = encode_processed(rows, name)
    assert dict(encoded.dtypes) == {"partition": "int", "value": "string"}
    decoded = decode_processed(encoded, name, carry=("partition",))
    assert decoded.exceptAll(rows).count() == rows.exceptAll(decoded).count() == 0


def test_processed_json_form(spark, zone):
    (row,) = encode_processed(normalize(raw(spark, {**TRADE, "p": "x"}), "trade"), "trade").collect()
    assert row.partition == 4
    assert row.value == (
        '{"trade_id":1,"timestamp_utc":"2023-11-14T22:13:20.000Z","symbol":"BTCUSDT",'
        '"quantity":2.00000000,"is_buyer_market_maker":true}'
    )


def test_quarantine_after_the_processed_topic(spark):
    rows = decode_processed(encode_processed(normalize(raw(spark, {**TRADE, "p": "x"}), "trade"), "trade"), "trade")
    assert [r.reject_reason for r in quarantined_rows(validate(rows, "trade")).collect()] == ["missing price"]


def test_routes_of_every_kind(spark, case_sensitive):
    rows = routes(spark, *ALL.values())
    assert [r.topic for r in rows] == [f"{k}_raw" for k in ALL]
    assert {r.partition for r in rows} == {T0 % 9}
    assert [r.value for r in rows] == [json.dumps(m) for m in ALL.values()]
    assert [r.interval for r in rows] == ["3m" if r.topic == "kline_raw" else None for r in rows]


ROUTED = [
    ('{"result":null,"id":1}', "acknowledgement"),
    ('{"result":null,"e":"trade","E":1}', "acknowledgement"),
    ('{"result":1,"id":1}', "unknown event"),
    ('{"result":1,"e":"trade","E":1}', None),
    ('{"e":"bookTicker","E":1}', "unknown event"),
    ('{"e":5,"E":1}', "unknown event"),
    ('{"e":{"a":1},"E":1}', "unknown event"),
    ('{"E":1}', "unknown event"),
    ('{"e":"trade","s":"B"}', "no event time"),
    ('{"e":"trade","E":null}', "no event time"),
    ('{"e":"trade","E":"1700"}', "bad event time"),
    ('{"e":"trade","E":1.5}', "bad event time"),
    ('{"e":"trade","E":true}', "bad event time"),
    ('{"e":"trade","E":99999999999999999999}', "bad event time"),
    ("not json", "malformed"),
    ("", "malformed"),
    (None, "malformed"),
    ('{"e":"trade","E":1', "malformed"),
    ('{"e":"trade","E":1} trailing', "malformed"),
    ('{"e":"trade","E":1}{"e":"trade","E":1}', "malformed"),
    ('{"e":"trade","E":1},{"e":"trade","E":1}', "malformed"),
    ('{"e":"trade","E":1,"E":2}', None),
    ("[1,2]", "not an object"),
    ('"result"', "not an object"),
    ("null", "not an object"),
    (' {"e":"trade","E":1} ', None),
]


def test_route_reasons(spark):
    rows = routes(spark, *(message for message, _ in ROUTED))
    assert [r.reject_reason for r in rows] == [reason for _, reason in ROUTED]
    assert [r.value for r in rows] == [message for message, _ in ROUTED]
    for row in rows:
        assert (row.topic is None) == (row.partition is None) == (row.reject_reason is not None)


EVENT_TIMES = [0, 1, T0, -1, -2, -10, 2**61 - 2, 2**61 - 1, 2**61, -(2**61), 2**63 - 1, -(2**63)]


@pytest.mark.parametrize("partitions", [1, 9, 16])
def test_partition_is_the_hash_of_the_event_time(spark, partitions):
    rows = routes(spark, *({"e": "trade", "E": ms} for ms in EVENT_TIMES), partitions=partitions)
    assert [r.partition for r in rows] == [hash(ms) % partitions for ms in EVENT_TIMES]


def test_rewritten_json(spark):
    (row,) = routes(spark, '{"e": "trade", "E": 5, "x": {"b": 1, "a": "\\u20ac"}}', rewrite_json=True)
    assert row.value == '{"E":5,"e":"trade","x":{"a":"€","b":1}}'


def test_routed_records(spark):
    records = routed_messages(route_raw(raw(spark, TRADE, "junk")))
    assert records.columns == ["topic", "partition", "value"]
    assert records.count() == 1


def test_endpoints_of_one_kind_share_it():
    assert [k.name for k in distinct_kinds(["kline_3m", "trade", "kline_5m", "kline"])] == ["kline", "trade"]
    assert [k.table for k in distinct_kinds(ALL)] == [
        "aggTrades", "trades", "klines", "miniTickers", "tickers", "avgPrices", "depths",
    ]


def repeated(message: dict, **first) -> str:
    """A message whose keys ``first`` come once more before, with other values."""
    return json.dumps(first)[:-1] + ", " + json.dumps(message)[1:]


def test_of_repeated_keys_the_last_value_routes(spark, case_sensitive):
    bar = json.dumps(KLINE).replace('"i":', '"i": "9m", "i":')
    rows = routes(
        spark,
        repeated(TRADE, e="kline", E=1, s="OTHER"),
        bar,
        repeated({**TRADE, "E": "soon"}, E=5),
        repeated({**TRADE, "e": "bookTicker"}, e="trade"),
        repeated({"id": 1, "result": None}, id=2),
        repeated(TRADE, e="x") + " {}",
        repeated(TRADE, e="x") + "]",
        repeated(TRADE, e="x")[:-1],
        "[" + repeated(TRADE, e="x") + "]",
        repeated(TRADE, e="x") + "," + json.dumps(TRADE),
        repeated(TRADE, e="x").replace('"', "'"),
        rewrite_json=True,
    )
    assert [(r.topic, r.symbol, r.interval, r.reject_reason) for r in rows[:2]] == [
        ("trade_raw", TRADE["s"], None, None), ("kline_raw", KLINE["s"], KLINE["k"]["i"], None),
    ]
    assert rows[0].value == repeated(TRADE, e="kline", E=1, s="OTHER") and rows[1].value == bar
    assert [r.reject_reason for r in rows[2:5]] == ["bad event time", "unknown event", "acknowledgement"]
    assert {r.reject_reason for r in rows[5:]} == {"malformed"}
    (plain,) = routes(spark, TRADE)
    assert rows[0].partition == plain.partition


def test_sound_messages_are_parsed_once(spark):
    routed = route_raw(raw(spark, TRADE), carry=("offset",)).filter("reject_reason IS NULL")
    text = routed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1 and len(re.findall("parse_?json", text, re.IGNORECASE)) == 1
    # The second parse is asked for where the first one gave nothing, and nowhere else.
    assert re.search(r"CASE WHEN isnull\(doc#\d+\) THEN (cast\()?from_json\(", text)
