"""DataFrame -> DataFrame operators; all of them work on batch and streaming frames."""

from marketflow.operators.codec import decode_processed, encode_processed
from marketflow.operators.latest import latest_klines
from marketflow.operators.normalize import normalize
from marketflow.operators.route import rejected_messages, route_raw, routed_messages
from marketflow.operators.subscribe import (
    Subscriptions,
    filter_subscribed,
    is_subscribed,
    subscription_pairs,
)
from marketflow.operators.validate import quarantined_rows, split_valid, valid_rows, validate

__all__ = [
    "Subscriptions",
    "decode_processed",
    "encode_processed",
    "filter_subscribed",
    "is_subscribed",
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
