"""Micro-batches that land once and feed any number of sinks from one read of the source.

A batch lands in a folder of its own, told by the query and the batch's number, and a marker
is written when it is whole. A batch that comes again after a failure finds its marker and
is not read from the source a second time; one that had not landed whole is replaced. Every
sink gets the landed rows, so all hold the same ones whatever computed them, and writes
under the same number, so that a repeated write finds its marker or replaces itself.

Small batches make small files; ``compact`` puts them together for readers, and ``follow``
is how a next hop takes the batches one by one.
"""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from staywise.sinks import versions

#: Partition columns of a landed table.
BATCH = StructType([StructField("query_id", StringType()), StructField("batch_id", LongType())])


class Batch(NamedTuple):
    """A query keeps its id across restarts from one checkpoint; numbers rise by one."""

    query: str
    number: int

    def folder(self, path: str) -> str:
        return f"{path}/query_id={self.query}/batch_id={self.number}"


def current(rows: DataFrame, number: int) -> Batch:
    """The batch that a ``foreachBatch`` function has been given."""
    return Batch(rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)


Sink = Callable[[DataFrame, Batch], None]


def _markers(path: str) -> str:
    return f"{path}-commits"


def _read_markers(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The markers below a folder; none if nothing was ever written there."""
    try:
        return spark.read.schema(schema).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``query_id, batch_id, committed_at`` of the batches that have landed whole."""
    fields = [*BATCH.fields, StructField("committed_at", StringType())]
    return _read_markers(spark, _markers(path), StructType(fields))


def is_committed(spark: SparkSession, path: str, batch: Batch) -> bool:
    marker = StructType([StructField("committed_at", StringType())])
    return not _read_markers(spark, batch.folder(_markers(path)), marker).isEmpty()


def write(rows: DataFrame, path: str, batch: Batch, fmt: str = "parquet") -> None:
    """Write a batch unless it is there; what an attempt cut short has left is replaced."""
    spark = rows.sparkSession
    if is_committed(spark, path, batch):
        return
    rows.write.format(fmt).mode("overwrite").save(batch.folder(path))
    marker = spark.range(1).select(F.current_timestamp().cast("string").alias("committed_at"))
    marker.coalesce(1).write.mode("overwrite").json(batch.folder(_markers(path)))


def _compacted(path: str) -> str:
    return f"{path}-compacted"


def _landed(
    spark: SparkSession, path: str, schema: StructType, fmt: str, found: list[Batch]
) -> DataFrame:
    """The rows of the given batches, with their ``BATCH`` columns."""
    wanted = StructType(schema.fields + BATCH.fields)
    if not found:
        return spark.createDataFrame([], wanted)
    reader = spark.read.format(fmt).schema(wanted).option("basePath", path)
    return reader.load([batch.folder(path) for batch in found])


def read(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", keep=()
) -> DataFrame:
    """The rows of all batches that have landed whole; ``keep`` may name ``BATCH`` columns.

    Batches that have been compacted are read from there, the later ones from their own
    folders. The driver lists those, as it lists their files.
    """
    marks = committed(spark, path).select(*BATCH.fieldNames())
    columns = [*keep, *schema.fieldNames()]
    if versions.versions(spark, _compacted(path)).isEmpty():
        fresh = [Batch(*row) for row in marks.collect()]
        return _landed(spark, path, schema, fmt, fresh).select(*columns)
    stored = StructType(schema.fields + BATCH.fields)
    done = versions.read(spark, _compacted(path), stored, fmt)
    # Batches of a query land in order, so what is compacted of it ends somewhere.
    upto = done.groupBy("query_id").agg(F.max("batch_id").alias("upto"))
    later = marks.join(upto, "query_id", "left").where("upto is null or batch_id > upto")
    fresh = [Batch(*row) for row in later.select(*BATCH.fieldNames()).collect()]
    return done.unionByName(_landed(spark, path, schema, fmt, fresh)).select(*columns)


def compact(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> int:
    """Put the rows of all whole batches into few files; returns the compaction's number.

    Readers at work go on with the files they have found; later ones take the new ones and
    whatever lands after. The batches' own folders stay, for queries that ``follow`` them.
    """
    rows = read(spark, path, schema, fmt, keep=BATCH.fieldNames())
    return versions.replace(rows.hint("rebalance"), _compacted(path), fmt)


def follow(
    spark: SparkSession,
    path: str,
    schema: StructType,
    checkpoint: str,
    sinks: list[Sink],
    fmt: str = "parquet",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """The next hop of a landed table: every batch goes to the sinks once it is whole.

    What is streamed are the markers, so neither a batch that was cut short nor a compaction
    is ever taken for new rows. ``options`` bound a step, such as ``maxFilesPerTrigger``.
    """
    marker = StructType([*BATCH.fields, StructField("committed_at", StringType())])
    marks = spark.readStream.schema(marker).options(**options).json(_markers(path))

    def each(rows: DataFrame, number: int) -> None:
        found = [Batch(*row) for row in rows.select(*BATCH.fieldNames()).collect()]
        landed = _landed(rows.sparkSession, path, schema, fmt, found).select(*schema.fieldNames())
        for sink in sinks:
            sink(landed, current(rows, number))

    writer = marks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def to_files(
    path: str, prepare: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet"
) -> Sink:
    """A sink into a landed table of its own, with ``prepare`` applied to the rows first."""

    def sink(rows: DataFrame, batch: Batch) -> None:
        write(rows if prepare is None else prepare(rows), path, batch, fmt)

    return sink


def fan_out_once(
    df: DataFrame,
    path: str,
    checkpoint: str,
    sinks: list[Sink] = (),
    fmt: str = "parquet",
    trigger: dict | None = None,
    name: str | None = None,
    stateful: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Land a stream as a table and feed every sink with the landed rows, batch by batch.

    One query, one checkpoint, one read of the source for each batch. A batch counts as done
    when the last sink has it; if one fails the query does, and goes on from the same batch
    when it is started again. Read tables with ``read``, which knows the whole batches.

    Say ``stateful`` if ``df`` keeps state: a repeated batch then runs again for its state,
    which Spark wants from every batch, though its rows are not written again. With the
    ``update`` mode a batch holds the rows that it has changed.
    """
    schema = df.schema

    def each(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        batch = current(rows, number)
        if stateful and is_committed(spark, path, batch):
            rows.write.format("noop").mode("overwrite").save()
        write(rows, path, batch, fmt)
        landed = spark.read.format(fmt).schema(schema).load(batch.folder(path))
        for sink in sinks:
            sink(landed, batch)

    writer = (
        df.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if name is not None:
        writer = writer.queryName(name)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()
