"""Instants and dates that do not depend on the session time zone (as SQL text)."""

from __future__ import annotations

# Seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z.
MIN_SECOND = -62_135_596_800
MAX_SECOND = 253_402_300_799


def epoch_ms_to_timestamp(ms: str) -> str:
    """Epoch milliseconds to a timestamp in whole seconds; the milliseconds are dropped.

    Values outside the years 1 to 9999 give null, where ``timestamp_seconds`` would
    overflow and end the query for one bad message.
    """
    seconds = f"({ms} div 1000)"
    return f"if({seconds} between {MIN_SECOND} and {MAX_SECOND}, timestamp_seconds({seconds}), null)"


def utc_date(ts: str) -> str:
    """UTC calendar date of a timestamp (``to_date`` would go by the session zone)."""
    return f"date_from_unix_date(cast(floor(unix_seconds({ts}) / 86400) as int))"
