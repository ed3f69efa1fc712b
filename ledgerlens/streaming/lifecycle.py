"""Running, watching and stopping stream queries."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def drain(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for a query that ends by itself (available-now trigger).

    The query's own failure is raised here. When the time is over the query is
    stopped and a TimeoutError is raised.
    """
    ended = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if timeout is not None and not ended:
        query.stop()
        raise TimeoutError(f"stream query {query.name or query.id} did not end in {timeout} s")
    return query


def run_until_stopped(queries: list[StreamingQuery], poll_seconds: float = 5.0) -> None:
    """Wait for all queries; the first failure or Ctrl-C stops the others.

    All queries are watched together, so a failure of any of them is noticed.
    """
    try:
        while active := [q for q in queries if q.isActive]:
            _raise_failures(queries)
            active[0].awaitTermination(poll_seconds)
        _raise_failures(queries)
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(queries)


def _raise_failures(queries: list[StreamingQuery]) -> None:
    for q in queries:
        failure = q.exception()
        if failure is not None:
            raise failure


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as late, over the kept progress reports."""
    return sum(
        int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
    )


def input_rows_per_batch(query: StreamingQuery) -> list[int]:
    """Input rows of each reported batch that had any; shows the intake limit."""
    return [int(p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
