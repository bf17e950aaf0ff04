"""One stream into several sinks."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def fan_out(
    df: DataFrame, starts: list[Callable[[DataFrame], StreamingQuery]]
) -> list[StreamingQuery]:
    """Start every sink on ``df``.

    Each start function brings its own checkpoint, so each sink keeps its own
    position, can fail and restart alone, and reads the source for itself. The sinks
    hold the same rows only once all of them have caught up. If one cannot start,
    those already running are stopped.
    """
    running: list[StreamingQuery] = []
    try:
        for start in starts:
            running.append(start(df))
    except Exception:
        for query in running:
            query.stop()
        raise
    return running
