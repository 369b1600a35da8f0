"""Queries that are started again when they fail, each by itself."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery


@dataclass
class Outcome:
    """How often a query was started again, and the error it was given up with, if it was."""

    restarts: int = 0
    error: Exception | None = None


def supervise(
    starts: Mapping[str, Callable[[], StreamingQuery]],
    restarts: int = 3,
    pause: float = 10.0,
    poll: float = 1.0,
    on_failure: Callable[[str, Exception], None] = lambda name, error: None,
) -> dict[str, Outcome]:
    """Start queries and keep them running until each has ended: drained, stopped, or failed for good.

    A query that fails is started again from its checkpoint after ``pause`` seconds, up to
    ``restarts`` times; that loses and repeats nothing, and the others run on meanwhile. ``on_failure``
    hears of every failure at once. A query that cannot be started counts as failed. Whoever wants
    out of live queries stops them, from another thread or with the session.
    """
    outcomes = {name: Outcome() for name in starts}
    running: dict[str, StreamingQuery] = {}
    due = dict.fromkeys(starts, 0.0)

    def failed(name: str, error: Exception) -> None:
        on_failure(name, error)
        outcome = outcomes[name]
        if outcome.restarts < restarts:
            outcome.restarts += 1
            due[name] = time.monotonic() + pause
        else:
            outcome.error = error

    while due or running:
        for name in [n for n, at in due.items() if at <= time.monotonic()]:
            del due[name]
            try:
                running[name] = starts[name]()
            except Exception as error:  # whatever keeps a query from starting
                failed(name, error)
        for name, query in list(running.items()):
            if not query.isActive:
                del running[name]
                error = query.exception()
                if error is not None:
                    failed(name, error)
        if due or running:
            time.sleep(poll)
    return outcomes
