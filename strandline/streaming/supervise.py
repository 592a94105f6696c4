"""Several queries in one driver (T4)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class QueryOutcome:
    name: str
    ok: bool
    error: str | None


def watch(
    queries: Mapping[str, StreamingQuery],
    timeout: float | None = None,
    poll: float = 0.2,
    on_end: Callable[[QueryOutcome], StreamingQuery | None] | None = None,
) -> list[QueryOutcome]:
    """Wait for every query and say how each one ended.

    A failing query does not end its siblings. ``on_end`` is called as soon as a query ends and may return
    a new query to watch under the same name. After ``timeout`` seconds what still runs is stopped and
    reported as not ok.
    """
    running = dict(queries)
    outcomes: list[QueryOutcome] = []
    deadline = None if timeout is None else time.monotonic() + timeout
    while running:
        for name, query in list(running.items()):
            if query.isActive:
                continue
            error = query.exception()
            outcome = QueryOutcome(name, error is None, None if error is None else str(error))
            del running[name]
            outcomes.append(outcome)
            again = on_end(outcome) if on_end else None
            if again is not None:
                running[name] = again
        if running and deadline is not None and time.monotonic() > deadline:
            for name, query in running.items():
                query.stop()
                outcomes.append(QueryOutcome(name, False, f"still running after {timeout} s"))
            break
        if running:
            time.sleep(poll)
    return outcomes
