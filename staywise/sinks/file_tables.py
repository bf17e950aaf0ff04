"""File tables, written once or appended to by a stream."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Process everything that is there now, then stop. Micro-batches are bounded where the
# source is: by ``maxFilesPerTrigger``, ``maxBytesPerTrigger`` or ``maxOffsetsPerTrigger``.
DRAIN = {"availableNow": True}

# Start the next micro-batch as soon as the last one is done, for ever.
KEEP_RUNNING = {"processingTime": "0 seconds"}


def files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by=(),
    **options,
) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def files_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    name: str | None = None,
    partition_by=(),
    **options,
) -> StreamingQuery:
    """Append a stream to a directory, exactly once across restarts.

    ``trigger`` is passed to Spark as is: ``DRAIN`` for a backlog, ``KEEP_RUNNING``
    (also Spark's default), or ``{"processingTime": "1 minute"}`` to keep files from
    becoming too small.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name is not None:
        writer = writer.queryName(name)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()
