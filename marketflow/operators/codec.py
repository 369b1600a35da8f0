"""The JSON form rows take on the processed topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.schemas import EVENT_MS, kind_of

# Instants are written in UTC whatever the session zone; null fields are left out.
_OPTIONS = {"timeZone": "UTC", "ignoreNullFields": "true"}


def encode_processed(rows: DataFrame, endpoint: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows as ``partition`` (int) and ``value`` (JSON of the table columns, and ``event_ms`` if there is one)."""
    columns = [*kind_of(endpoint).columns, *(c for c in rows.columns if c == EVENT_MS)]
    return rows.select(
        F.col("partition").cast("int").alias("partition"),
        F.to_json(F.struct(*columns), _OPTIONS).alias("value"),
        *carry,
    )


def decode_processed(processed: DataFrame, endpoint: str, carry: Sequence[str] = ()) -> DataFrame:
    """Rows back from their JSON form, typed as in the table; what does not parse is null.

    ``event_ms`` in ``carry`` is read from the JSON as well.
    """
    kind = kind_of(endpoint)
    schema = kind.table_schema
    if EVENT_MS in carry:
        schema = T.StructType([*schema.fields, T.StructField(EVENT_MS, T.LongType())])
    row = F.from_json(F.col("value").cast("string"), schema, _OPTIONS)
    return processed.select(F.inline(F.array(row)), *(c for c in carry if c != EVENT_MS))
