"""What a load stored and rejected, micro-batch by micro-batch, counted while it is written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketflow.operators.validate import REASON, faults_of
from marketflow.schemas import EVENT_MS

NAME = "marketflow_load"


def observed(rows: DataFrame, endpoint: str) -> DataFrame:
    """``rows`` as a table folder stores them, counted on the way: no second pass and no shuffle."""
    faults = F.split(REASON, ", ")
    counts = [F.count_if(F.array_contains(faults, f)).alias(f) for f in faults_of(endpoint)]
    return rows.observe(
        NAME, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
        F.max(EVENT_MS).alias("newest_event_ms"), *counts,
    )


def metrics_in(progress) -> dict | None:
    """A progress report's counts: ``batch, rows, rejected, newest_event_ms`` and ``faults``; null if it has none."""
    found = progress.observedMetrics.get(NAME)
    if found is None:
        return None
    counts = found.asDict()
    head = {name: counts.pop(name) for name in ("rows", "rejected", "newest_event_ms")}
    return {"batch": progress.batchId, **head, "faults": {fault: n for fault, n in counts.items() if n}}


def metrics_of(query: StreamingQuery) -> list[dict]:
    """Counts of a query's recent micro-batches (Spark keeps a hundred unless told otherwise)."""
    return [m for m in map(metrics_in, query.recentProgress) if m and m["rows"]]


class MetricsListener(StreamingQueryListener):
    """Hands the counts of every micro-batch on as they come: ``sink(query name, counts)``."""

    def __init__(self, sink: Callable[[str | None, dict], None]):
        self.sink = sink

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = metrics_in(event.progress)
        if found:
            self.sink(event.progress.name, found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
