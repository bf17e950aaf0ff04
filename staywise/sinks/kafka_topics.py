"""Kafka topics. Delivery is at least once: a retried batch can repeat messages."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staywise.sinks.batches import Batch, Sink


def options(servers: str, topic: str, checkpoint: str, **extra) -> dict[str, str]:
    base = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "checkpointLocation": checkpoint,
    }
    return base | {name: str(value) for name, value in extra.items()}


def message_columns(df: DataFrame) -> DataFrame:
    """Only the columns a Kafka sink understands; ``value`` must be among them."""
    if "value" not in df.columns:
        raise ValueError("a Kafka sink needs a 'value' column; see gold.to_message")
    return df.select(*[c for c in ("key", "value", "headers") if c in df.columns])


def kafka(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    **extra,
) -> StreamingQuery:
    writer = (
        message_columns(df)
        .writeStream.format("kafka")
        .outputMode("append")
        .options(**options(servers, topic, checkpoint, **extra))
    )
    if name is not None:
        writer = writer.queryName(name)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def batch_messages(df: DataFrame, batch: Batch) -> DataFrame:
    """Messages with a ``batch`` header, by which a reader can tell a batch sent again."""
    messages = message_columns(df)
    value = F.lit(f"{batch.query}/{batch.number}").cast("binary")
    header = F.array(F.struct(F.lit("batch").alias("key"), value.alias("value")))
    if "headers" in messages.columns:
        header = F.concat(F.coalesce("headers", F.array().cast(header_type())), header)
    return messages.withColumn("headers", header)


def header_type() -> str:
    return "array<struct<key: string, value: binary>>"


def kafka_batches(
    servers: str,
    topic: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    **extra,
) -> Sink:
    """A sink for ``fan_out_once``. A batch that failed on the way is sent again whole."""
    base = {"kafka.bootstrap.servers": servers, "topic": topic}
    settings = base | {name: str(value) for name, value in extra.items()}

    def sink(rows: DataFrame, batch: Batch) -> None:
        ready = rows if prepare is None else prepare(rows)
        batch_messages(ready, batch).write.format("kafka").options(**settings).save()

    return sink
