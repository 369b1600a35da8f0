"""Raw messages of one kind to named, typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions import epoch_ms_to_timestamp, parse_message, top_levels
from marketflow.schemas import EVENT_MS, kind_of


def normalize(raw: DataFrame, endpoint: str, carry: Sequence[str] = ("partition",)) -> DataFrame:
    """Parse ``value`` of every row and project it to the columns of ``endpoint``'s table.

    A field that does not parse is null, and so is every field of a message that does
    not parse at all. Columns named in ``carry`` pass through; ``event_ms`` among them is
    the message's event time in milliseconds.

    The parsed struct is flattened by ``inline`` over a one-element array. Through a plain
    projection Catalyst pushes later filters on the parsed columns down and repeats
    ``from_json`` once per filtered column; nothing is pushed through a generator, so
    each message is parsed once.
    """
    kind = kind_of(endpoint)
    passed = [c for c in carry if c != EVENT_MS]
    flat = raw.select(*passed, F.inline(F.array(parse_message(F.col("value"), kind))))

    def column(field):
        path = f"`{kind.nested}`.`{field.name}`" if "." in field.wire else f"`{field.name}`"
        if field.logical == "millis":
            path = epoch_ms_to_timestamp(path)
        elif field.logical == "book":
            path = top_levels(path)
        return f"{path} as `{field.name}`"

    carried = [f"timestamp_utc as {EVENT_MS}" if c == EVENT_MS else f"`{c}`" for c in carry]
    return flat.selectExpr(*map(column, kind.fields), *carried)
