"""The registered queries' answers, stated in SQL straight from the test tables."""

from __future__ import annotations

K = "CAST(props->>'$.k' AS BIGINT)"


def number(expression: str, precision: int = 14, scale: int = 8) -> str:
    return f"CAST(CAST({expression} AS DECIMAL({precision},{scale})) AS VARCHAR)"


def millis(ts: str) -> str:
    """Whole milliseconds; DuckDB's ``epoch_ms`` rounds up where Spark's ``unix_millis`` does not."""
    return f"(epoch_us({ts}) // 1000)"


def seconds(ts: str) -> str:
    return f"epoch_us({ts}) // 1000000"


def partition(ts: str) -> str:
    return f"CAST({millis(ts)} % 9 AS INTEGER)"


VALUE = "CAST(value AS DECIMAL(14,8))"
TOTAL = "CAST(o_totalprice AS DECIMAL(14,8))"

TRADE_COLUMNS = f"""
    event_id AS trade_id,
    {seconds("ts")} AS timestamp_utc,
    upper(event_type) AS symbol,
    {number("value")} AS price,
    {number(K, 18)} AS quantity,
    event_id % 2 = 0 AS is_buyer_market_maker
"""


def kline_columns(first_id: str, last_id: str) -> str:
    opened = "(epoch_us(ts) // 3600000000) * 3600"
    return f"""
    {first_id} AS first_trade_id,
    {last_id} AS last_trade_id,
    {seconds("ts")} AS timestamp_utc,
    {opened} AS open_timestamp_utc,
    {opened} + 3599 AS close_timestamp_utc,
    upper(event_type) AS symbol,
    '1h' AS "interval",
    {K} AS num_trades,
    event_id % 2 = 1 AS is_closed,
    {number(VALUE)} AS open_price,
    {number(VALUE + " + 1")} AS close_price,
    {number(VALUE + " + 2")} AS high_price,
    {number(VALUE + " - 0.01")} AS low_price,
    {number(K, 18)} AS base_asset_volume,
    {number(K + " * 2", 18)} AS quote_asset_volume,
    {number(K + " * 3", 18)} AS taker_buy_base_asset_volume,
    {number(K + " * 4", 18)} AS taker_buy_quote_asset_volume
"""


RAW_KLINES = kline_columns(
    "CASE WHEN event_id % 50 = 0 THEN -1 ELSE event_id END",
    f"CASE WHEN event_id % 50 = 0 THEN -1 ELSE event_id + {K} END",
)
TABLE_KLINES = kline_columns(
    "CASE WHEN event_id % 50 = 0 THEN 1 ELSE event_id END",
    f"CASE WHEN event_id % 50 = 0 THEN 1 ELSE event_id + {K} END",
)
LATEST_KLINES = f"""
SELECT {TABLE_KLINES}
FROM events
QUALIFY row_number() OVER (
    PARTITION BY event_type, epoch_us(ts) // 3600000000
    ORDER BY {millis("ts")} DESC, event_id DESC
) = 1
"""

ROUTE_REASON = """
CASE
    WHEN event_id % 97 = 0 THEN 'acknowledgement'
    WHEN event_id % 89 = 0 THEN 'unknown event'
    WHEN event_id % 83 = 0 THEN 'no event time'
    WHEN event_id % 79 = 0 THEN 'malformed'
    WHEN event_id % 73 = 0 THEN 'bad event time'
    WHEN event_id % 71 = 0 THEN 'not an object'
    WHEN event_id % 67 = 0 THEN 'malformed'
END
"""

REPEATED_REASON = """
CASE
    WHEN event_id % 41 = 0 OR event_id % 37 = 0 OR event_id % 31 = 0 THEN 'malformed'
    WHEN event_id % 29 = 0 THEN 'unknown event'
    WHEN event_id % 23 = 0 THEN 'bad event time'
END
"""

QUARANTINE_REASON = """
CASE
    WHEN event_id % 71 = 0 THEN 'missing trade_id, missing timestamp_utc, missing symbol, missing price, '
        || 'missing quantity, missing is_buyer_market_maker'
    ELSE nullif(concat_ws(', ',
        CASE WHEN event_id % 83 = 0 THEN 'negative trade_id' END,
        CASE WHEN event_id % 73 = 0 THEN 'missing timestamp_utc' END,
        CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'missing price' END,
        CASE WHEN event_id % 79 = 0 THEN 'missing quantity' END), '')
END
"""

TRADE_JSON = f"""
    '{{"E":' || {millis('ts')} || ',"M":true,"T":' || {millis('ts')}
    || ',"e":"trade","m":' || (event_id % 2 = 0)
    || ',"p":"' || {number("value")} || '","q":"' || {number(K, 18)}
    || '","s":"' || upper(event_type) || '","t":' || event_id || '}}'
"""

PROCESSED_JSON = f"""
    '{{"trade_id":' || event_id
    || ',"timestamp_utc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z')
    || '","symbol":"' || upper(event_type)
    || '","price":' || {number("value")}
    || ',"quantity":' || CASE WHEN {K} = 0 THEN '0E-8' ELSE {number(K, 18)} END
    || ',"is_buyer_market_maker":' || (event_id % 2 = 0) || '}}'
"""

SIDE_LEVELS = """
    SELECT event_id, ts, event_type, value, side, unnest(range(least(event_id % 8 + 1, 5))) AS level
    FROM events, (VALUES ('bid'), ('ask')) sides(side)
"""

PART_MS = "(1700000000123 + p_partkey * 1000)"
AVG_PRICE_COLUMNS = f"""
    {PART_MS} // 1000 AS timestamp_utc,
    ({PART_MS} - 7) // 1000 AS last_trade_timestamp_utc,
    p_brand AS symbol,
    '5m' AS avg_price_interval,
    {number("p_retailprice")} AS avg_price
"""

ORACLES = {
    "trades_normalized": f"SELECT {TRADE_COLUMNS}, {partition('ts')} AS partition FROM events",
    "agg_trades_normalized": f"""
        SELECT
            l_orderkey AS first_trade_id,
            l_orderkey + l_linenumber AS last_trade_id,
            l_orderkey * 10 + l_linenumber AS aggregate_trade_id,
            {seconds("l_shipdate")} AS timestamp_utc,
            l_returnflag || l_linestatus AS symbol,
            {number("l_extendedprice")} AS price,
            {number("l_quantity", 18)} AS quantity,
            l_linenumber % 2 = 0 AS is_buyer_market_maker,
            {partition("l_shipdate")} AS partition
        FROM lineitem
    """,
    "klines_normalized": f"SELECT {RAW_KLINES}, {partition('ts')} AS partition FROM events",
    "klines_latest": LATEST_KLINES,
    "klines_latest_partitioned": LATEST_KLINES,
    "mini_tickers_normalized": f"""
        SELECT
            {seconds("o_orderdate")} AS timestamp_utc,
            o_orderstatus AS symbol,
            {number(TOTAL)} AS open_price,
            {number(TOTAL + " + 1")} AS close_price,
            {number(TOTAL + " + 2")} AS high_price,
            {number(TOTAL + " - 1")} AS low_price,
            {number("o_orderkey * 1000", 20)} AS total_base_asset_volume,
            {number("o_custkey * 1000", 20)} AS total_quote_asset_volume
        FROM orders
    """,
    "tickers_normalized": f"""
        SELECT
            o_orderkey AS first_trade_id,
            o_orderkey + 7 AS last_trade_id,
            {seconds("o_orderdate")} AS timestamp_utc,
            ({millis('o_orderdate')} - 86400000) // 1000 AS open_timestamp_utc,
            ({millis('o_orderdate')} - 1) // 1000 AS close_timestamp_utc,
            o_orderstatus AS symbol,
            {number(TOTAL + " - 250000")} AS price_change,
            {number("(o_orderkey % 200000 - 100000) * CAST(0.001 AS DECIMAL(4,3))", 7, 3)} AS price_change_percent,
            {number(TOTAL)} AS weighted_avg_price,
            CAST(8 AS BIGINT) AS num_trades,
            {number(TOTAL + " - 2")} AS first_trade_price,
            {number(TOTAL)} AS open_price,
            {number(TOTAL + " + 1")} AS close_price,
            {number(TOTAL + " + 2")} AS high_price,
            {number(TOTAL + " - 1")} AS low_price,
            {number(TOTAL + " - 3")} AS best_bid_price,
            {number("o_orderkey % 100", 18)} AS best_bid_quantity,
            {number(TOTAL + " + 3")} AS best_ask_price,
            {number("o_orderkey % 10", 18)} AS best_ask_quantity,
            {number("o_orderkey % 1000", 18)} AS last_quantity,
            {number("o_orderkey * 1000", 20)} AS total_base_asset_volume,
            {number("o_custkey * 1000", 20)} AS total_quote_asset_volume
        FROM orders
    """,
    "avg_prices_normalized": f"SELECT {AVG_PRICE_COLUMNS} FROM part",
    "depth_top5": f"""
        SELECT
            {seconds("ts")} AS timestamp_utc,
            upper(event_type) AS symbol,
            event_id AS first_update_id,
            event_id + 2 AS final_update_id,
            side,
            CAST(level AS INTEGER) AS level,
            {number(f"{VALUE} + level + CASE WHEN side = 'ask' THEN 0.25 ELSE 0 END", 18)} AS price,
            {number("level", 18)} AS quantity
        FROM ({SIDE_LEVELS})
    """,
    "routed_raw": f"""
        SELECT 'trade_raw' AS topic, {partition("ts")} AS partition, {TRADE_JSON} AS value, event_id AS "offset"
        FROM events WHERE ({ROUTE_REASON}) IS NULL
    """,
    "route_rejects": f"""
        SELECT event_id AS "offset", {ROUTE_REASON} AS reject_reason
        FROM events WHERE ({ROUTE_REASON}) IS NOT NULL
    """,
    "route_repeated_keys": f"""
        WITH judged AS (SELECT *, ({REPEATED_REASON}) AS reason FROM events)
        SELECT event_id AS "offset", coalesce(reason, '') AS reject_reason,
            CASE WHEN reason IS NOT NULL THEN '' WHEN event_id % 3 = 0 THEN 'trade_raw'
                WHEN event_id % 3 = 1 THEN 'kline_raw' ELSE 'depth_raw' END AS topic,
            CASE WHEN reason IS NULL THEN upper(event_type) ELSE '' END AS symbol,
            CASE WHEN reason IS NULL AND event_id % 3 = 1 THEN '1h' ELSE '' END AS "interval",
            CASE WHEN reason IS NULL THEN {partition("ts")} ELSE -1 END AS partition
        FROM judged
    """,
    "trades_repeated_keys": f"""
        SELECT {TRADE_COLUMNS} FROM events WHERE ({REPEATED_REASON}) IS NULL AND event_id % 3 = 0
    """,
    "trades_lookup": f"SELECT {TRADE_COLUMNS} FROM events WHERE event_type = 'click' AND event_id BETWEEN 700 AND 1300",
    "subscription_filter": f"""
        SELECT kind || '_raw' AS topic, {partition("ts")} AS partition, upper(event_type) AS symbol,
            bar AS "interval", event_id AS "offset"
        FROM events, (VALUES ('trade', ''), ('kline', '1h'), ('depth', '')) kinds(kind, bar)
        WHERE event_type IN ('click', 'purchase')
    """,
    "subscription_pairs": """
        SELECT market, endpoint, market || '@' || endpoint AS subscription
        FROM (SELECT DISTINCT lower(event_type) AS market FROM events),
            (VALUES ('trade'), ('kline_3m'), ('kline_1h'), ('depth')) endpoints(endpoint)
    """,
    "topics_of_endpoints": """
        SELECT DISTINCT event_type AS endpoint, event_type || '_raw' AS topic FROM events
    """,
    "valid_trades": f"""
        SELECT {TRADE_COLUMNS}, {partition("ts")} AS partition
        FROM events WHERE ({QUARANTINE_REASON}) IS NULL
    """,
    "quarantine_reasons": f"""
        SELECT event_id AS "offset", {QUARANTINE_REASON} AS reject_reason
        FROM events WHERE ({QUARANTINE_REASON}) IS NOT NULL
    """,
    "processed_encoded": f"""
        SELECT {partition("ts")} AS partition, {PROCESSED_JSON} AS value, event_id AS "offset" FROM events
    """,
    "processed_roundtrip": f"SELECT {TABLE_KLINES}, {partition('ts')} AS partition FROM events",
    "trades_table": f"SELECT {TRADE_COLUMNS} FROM events",
    "catalog_table": f"SELECT {AVG_PRICE_COLUMNS} FROM part",
    "klines_compacted": LATEST_KLINES,
    "klines_recompacted": LATEST_KLINES,
    "stream_trades": f"SELECT {TRADE_COLUMNS} FROM events WHERE ({ROUTE_REASON}) IS NULL",
    "stream_klines_latest": LATEST_KLINES,
    # Broken JSON already ends at routing.
    "stream_quarantine": f"""
        SELECT event_id AS "offset", {QUARANTINE_REASON} AS reject_reason
        FROM events WHERE ({QUARANTINE_REASON}) IS NOT NULL AND event_id % 71 <> 0
    """,
    "stream_compacted": f"SELECT {AVG_PRICE_COLUMNS} FROM part",
    "stream_subscribed": f"SELECT {TRADE_COLUMNS} FROM events WHERE event_type = 'click'",
    "stream_dead_letters": f"""
        SELECT event_id AS "offset", {ROUTE_REASON} AS reject_reason,
            CASE WHEN event_id % 83 = 0 THEN '{{"e":"tr' WHEN event_id % 79 = 0 THEN 'not json'
                WHEN event_id % 73 = 0 THEN '{{"e":"tr' WHEN event_id % 71 = 0 THEN '[{{"e":"t' ELSE '{{"e":"tr' END AS begins
        FROM events WHERE ({ROUTE_REASON}) NOT IN ('acknowledgement', 'unknown event')
    """,
    "stream_resumed": f"SELECT {TRADE_COLUMNS} FROM events",
    "stream_rate_limited": """
        SELECT upper(event_type) AS symbol, event_id AS id, kind FROM events, (VALUES ('trade'), ('depth')) kinds(kind)
    """,
    "backfilled_twice": f"SELECT {TRADE_COLUMNS} FROM events",
    "backfilled_processed": LATEST_KLINES,
    "backfilled_gaps": f"SELECT {TRADE_COLUMNS} FROM events",
    "backfilled_positions": f"""
        SELECT {partition("ts")} AS partition, CAST(0 AS BIGINT) AS first, count(*) - 1 AS last FROM events GROUP BY 1
    """,
    "backfilled_range": f"""
        SELECT {TRADE_COLUMNS} FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03'
    """,
    "topic_offsets": f"""
        SELECT 'trade_raw' AS topic, {partition("ts")} AS partition, CAST(event_id % 2 AS INTEGER) AS half,
            row_number() OVER (PARTITION BY {partition("ts")} ORDER BY event_id % 2, event_id) - 1 AS "offset"
        FROM events
    """,
    "klines_published": LATEST_KLINES,
    "klines_bucketed": LATEST_KLINES,
    "stream_klines_state": LATEST_KLINES,
    # Broken JSON already ends at routing.
    "stream_metrics": f"""
        WITH judged AS (SELECT ({QUARANTINE_REASON}) AS reason FROM events WHERE event_id % 71 <> 0)
        SELECT 'rows' AS metric, count(*) AS n FROM judged
        UNION ALL SELECT 'rejected', count(reason) FROM judged
        UNION ALL SELECT fault, count(*) FROM (SELECT unnest(string_split(reason, ', ')) AS fault FROM judged) GROUP BY fault
    """,
    "backfilled_depths": f"""
        SELECT
            {seconds("ts")} AS timestamp_utc,
            upper(event_type) AS symbol,
            event_id AS first_update_id,
            event_id + 2 AS final_update_id,
            CAST(least(event_id % 8 + 1, 5) AS INTEGER) AS bid_levels,
            CAST(least(event_id % 8 + 1, 5) AS INTEGER) AS ask_levels,
            {number(VALUE, 18)} AS best_bid,
            {number(VALUE + " + 0.25", 18)} AS best_ask
        FROM events
    """,
}
