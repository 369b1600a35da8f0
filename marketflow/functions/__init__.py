"""Expressions the operators are made of, as columns or as SQL text."""

from marketflow.functions.messages import (
    base_endpoint,
    has_nulls,
    magnitude,
    parse_message,
    top_levels,
    topic_partition,
)
from marketflow.functions.times import epoch_ms_to_timestamp, utc_date

__all__ = [
    "base_endpoint",
    "epoch_ms_to_timestamp",
    "has_nulls",
    "magnitude",
    "parse_message",
    "top_levels",
    "topic_partition",
    "utc_date",
]
