"""Kafka topics. Needs the Spark Kafka connector on the session's class path."""

from pyspark.sql import DataFrame, SparkSession


def options(servers: str, topic: str, starting: str = "latest", **extra) -> dict[str, str]:
    """Reader options. ``starting`` only matters before the first checkpoint.

    ``extra`` passes through; ``maxOffsetsPerTrigger`` bounds a micro-batch and
    ``minPartitions`` splits topic partitions that are too large for one task.
    """
    base = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    return base | {name: str(value) for name, value in extra.items()}


def kafka(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **extra
) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**options(servers, topic, starting, **extra))
        .load()
    )
