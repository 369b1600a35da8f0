"""marketflow: exchange market-data messages to typed tables, on Spark."""

from marketflow.operators import (
    Subscriptions,
    decode_processed,
    encode_processed,
    filter_subscribed,
    latest_klines,
    normalize,
    quarantined_rows,
    rejected_messages,
    route_raw,
    routed_messages,
    split_valid,
    subscription_pairs,
    valid_rows,
    validate,
)
from marketflow.schemas import KINDS, distinct_kinds, kind_of

__all__ = [
    "KINDS",
    "Subscriptions",
    "decode_processed",
    "distinct_kinds",
    "encode_processed",
    "filter_subscribed",
    "kind_of",
    "latest_klines",
    "normalize",
    "quarantined_rows",
    "rejected_messages",
    "route_raw",
    "routed_messages",
    "split_valid",
    "subscription_pairs",
    "valid_rows",
    "validate",
]
