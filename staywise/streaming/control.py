"""Waiting for streams."""

from pyspark.sql.streaming import StreamingQuery


def stop_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def await_all(queries: list[StreamingQuery], poll: int = 5) -> None:
    """Block until every query has ended; the first failure stops the rest.

    All queries are watched, so none fails unseen while another runs for longer than
    ``poll`` seconds. Other queries of the session are left alone.
    """
    try:
        while True:
            for query in queries:
                if not query.isActive:
                    query.awaitTermination()  # raises what the query raised
            active = [query for query in queries if query.isActive]
            if not active:
                return
            active[0].awaitTermination(poll)
    finally:
        stop_all(queries)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query with an ``availableNow`` trigger; raises what it raised."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query
