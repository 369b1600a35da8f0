"""Table rows split from rows no table can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions import has_nulls, magnitude
from marketflow.schemas import Field, kind_of

REASON = "reject_reason"


def _faults(field: Field) -> list[tuple[str, str]]:
    """Conditions (never null) under which a column is not fit for the table, and their names."""
    value = f"`{field.name}`"
    faults = [(f"{value} is null", f"missing {field.name}")]
    if field.non_negative:
        faults.append((f"coalesce({value} < 0, false)", f"negative {field.name}"))
    if field.logical == "book":
        faults.append((f"({value} is not null and {has_nulls(value)})", f"incomplete {field.name}"))
    return faults


def validate(rows: DataFrame, endpoint: str) -> DataFrame:
    """Add ``reject_reason``: null on rows fit for the table, else every fault found.

    All columns are required, ids and counts may not be negative, and books may hold no
    nulls. Candlestick trade ids are made absolute first. One frame carries both outcomes,
    so one pass over the source can feed the table and the quarantine.

    The reason comes out of a generator over a one-element array, which keeps it a plain
    column: through a projection a filter on it becomes one condition per column, and
    inferring constraints from those took Catalyst seconds per query.
    """
    kind = kind_of(endpoint)
    if kind.magnitudes:
        rows = rows.withColumns({c: F.expr(magnitude(f"`{c}`")) for c in kind.magnitudes})
    faults = [fault for field in kind.fields for fault in _faults(field)]
    faulty = " or ".join(condition for condition, _ in faults)
    # The list of faults is only put together for faulty rows.
    texts = ", ".join(f"if({condition}, '{text}', null)" for condition, text in faults)
    reason = f"if({faulty}, concat_ws(', ', {texts}), null)"
    return rows.selectExpr("*", f"explode(array({reason})) as {REASON}")


def faults_of(endpoint: str) -> list[str]:
    """Every fault that a reject reason of a kind may name."""
    return [text for field in kind_of(endpoint).fields for _, text in _faults(field)]


def valid_rows(checked: DataFrame, endpoint: str, *extra: str) -> DataFrame:
    """Rows fit for the table, in table column order, followed by ``extra`` columns."""
    return checked.filter(F.col(REASON).isNull()).select(*kind_of(endpoint).columns, *extra)


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def split_valid(rows: DataFrame, endpoint: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)`` frames of ``rows``."""
    checked = validate(rows, endpoint)
    return valid_rows(checked, endpoint), quarantined_rows(checked)
