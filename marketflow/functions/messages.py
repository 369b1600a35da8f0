"""Expressions over exchange messages.

Those that go into wide projections are SQL text: dozens of columns built one call at a
time cost the driver more than the whole projection as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketflow.schemas import BOOK_LEVELS, Kind

# Larger than any book entry, so no element ever equals it.
_ABSENT = "cast(1000000000000 as decimal(21,8))"

# Python hashes an integer as its remainder by this prime; raw topics are keyed by that hash.
_HASH_PRIME = 2**61 - 1


def parse_message(value: Column, kind: Kind) -> Column:
    """Parse one JSON message by the fixed schema of its kind, permissively.

    Wire names such as ``e``/``E`` differ only by case. Struct casts go by position, so
    casting to uniquely named fields works whatever ``spark.sql.caseSensitive`` says.
    """
    return F.from_json(value.cast("string"), kind.wire_ddl).cast(kind.named_ddl)


def top_levels(book: str, levels: int = BOOK_LEVELS) -> str:
    """The first levels of an order-book side, in the order sent."""
    return f"slice({book}, 1, {levels})"


def has_nulls(book: str) -> str:
    """Whether a level or a number in a book side is null (a null side counts too).

    ``array_contains`` answers null instead of false when the array holds a null, and
    unlike a lambda it stays inside generated code.
    """
    return f"array_contains(flatten({book}), {_ABSENT}) is null"


def magnitude(value: str) -> str:
    """Absolute value; null where it does not fit a long."""
    return f"if({value} >= 0, {value}, try_subtract(0L, {value}))"


def topic_partition(event_time: Column, partitions: int) -> Column:
    """Topic partition of a message, from its event time in milliseconds."""
    rest = event_time % F.lit(_HASH_PRIME)
    hashed = F.when(rest == -1, F.lit(-2).cast("bigint")).otherwise(rest)
    return F.pmod(hashed, F.lit(partitions)).cast("int")


def base_endpoint(endpoint: Column) -> Column:
    """``kline_3m`` -> ``kline``; names without a suffix stay as they are."""
    return F.split_part(endpoint, F.lit("_"), F.lit(1))
