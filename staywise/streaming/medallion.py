"""The two lanes from messages to feature tables.

Each hop is its own query over the file table of the hop before, so hops restart
and scale independently. No hop keeps state or shuffles. With ``DRAIN``, the default,
a lane works off its backlog and returns; with any other trigger the hops run side by
side and are returned still running, to be given to ``control.await_all``.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from staywise import sinks, sources
from staywise.config import FeatureRules
from staywise.operators import bronze, gold, silver
from staywise.schemas import (
    CUSTOMER_EVENT,
    GOLD_TRAINING,
    RAW,
    SCORING_EVENT,
    STAMPED_EVENT,
)
from staywise.sinks import versions
from staywise.sinks.file_tables import DRAIN
from staywise.streaming.control import drain


@dataclass(frozen=True)
class LanePaths:
    """Table and checkpoint folders of one lane, all below one shared root."""

    root: str

    def table(self, hop: str) -> str:
        return f"{self.root}/{hop}"

    def checkpoint(self, hop: str) -> str:
        return f"{self.root}/checkpoints/{hop}"


def _hop(df, paths, name, fmt, trigger, wait, partition_by=()) -> StreamingQuery:
    query = sinks.files_stream(
        df,
        paths.table(name),
        paths.checkpoint(name),
        fmt=fmt,
        trigger=trigger,
        partition_by=partition_by,
    )
    return drain(query) if wait else query


def _next(spark, paths, name, schema, fmt, read_options) -> DataFrame:
    """The hop before as a stream. Starting a file sink creates its folder and
    commit log, so this works before that hop has written its first row."""
    return sources.files_stream(spark, paths.table(name), schema, fmt=fmt, **read_options)


def training_lane(
    messages: DataFrame,
    paths: LanePaths,
    fmt: str = "parquet",
    trigger: dict = DRAIN,
    partition_by=(),
    **read_options,
) -> list[StreamingQuery]:
    """Messages → bronze (raw text) → silver (parsed). Gold is built in batch from
    silver by ``training_gold``, as training wants a full, replaceable table.
    ``partition_by`` names columns that divide the silver table."""
    spark, wait = messages.sparkSession, "availableNow" in trigger
    first = _hop(bronze.decode(messages), paths, "bronze", fmt, trigger, wait)
    raw = _next(spark, paths, "bronze", RAW, fmt, read_options)
    second = _hop(silver.parse(raw), paths, "silver", fmt, trigger, wait, partition_by)
    return [first, second]


def training_gold(
    spark: SparkSession,
    paths: LanePaths,
    fmt: str = "parquet",
    rules: FeatureRules = FeatureRules(),
    versioned: bool = False,
) -> DataFrame:
    """Rebuild the gold table from silver (full overwrite) and return it.

    A ``versioned`` table is replaced by a new version, which readers at work survive; read
    it with ``sinks.versions.read``.
    """
    parsed = sources.files(spark, paths.table("silver"), fmt, CUSTOMER_EVENT)
    if versioned:
        versions.replace(gold.features(parsed, rules), paths.table("gold"), fmt)
        return versions.read(spark, paths.table("gold"), GOLD_TRAINING, fmt)
    sinks.files(gold.features(parsed, rules), paths.table("gold"), fmt)
    return sources.files(spark, paths.table("gold"), fmt, GOLD_TRAINING)


def scoring_lane(
    messages: DataFrame,
    paths: LanePaths,
    fmt: str = "parquet",
    trigger: dict = DRAIN,
    clock: Column | None = None,
    rules: FeatureRules = FeatureRules(),
    publish=(),
    publish_batches=None,
    partition_by=(),
    **read_options,
) -> list[StreamingQuery]:
    """Messages → bronze (parsed, stamped) → silver → gold, the last hop also into
    every sink in ``publish``: functions that start a query on the message frame, each with
    a read of its own.

    With ``publish_batches``, a list of batch sinks, one query reads silver once for the gold
    table and all of them; the table is then one for ``sinks.batches.read``.
    ``partition_by`` names columns that divide the table otherwise."""
    if publish_batches is not None and (publish or partition_by):
        raise ValueError("publish_batches stands alone, without publish or partition_by")
    spark, wait = messages.sparkSession, "availableNow" in trigger

    keep = () if clock is None else ("timestamp",)
    parsed = silver.parse(bronze.decode(messages, keep=keep), SCORING_EVENT, keep=keep)
    stamped = silver.conform(bronze.stamp(parsed, clock), STAMPED_EVENT)
    first = _hop(stamped, paths, "bronze", fmt, trigger, wait)

    landed = _next(spark, paths, "bronze", STAMPED_EVENT, fmt, read_options)
    conformed = silver.conform(landed, STAMPED_EVENT)
    second = _hop(conformed, paths, "silver", fmt, trigger, wait)

    clean = _next(spark, paths, "silver", STAMPED_EVENT, fmt, read_options)
    featured = gold.features(clean, rules)

    if publish_batches is not None:
        last = sinks.fan_out_once(
            featured, paths.table("gold"), paths.checkpoint("gold"), publish_batches, fmt, trigger
        )
        return [first, second, drain(last) if wait else last]

    def to_table(df):
        return _hop(df, paths, "gold", fmt, trigger, False, partition_by)

    def to_sink(start):
        return lambda df: start(gold.to_message(df))

    last = sinks.fan_out(featured, [to_table, *map(to_sink, publish)])
    if wait:
        for query in last:
            drain(query)
    return [first, second, *last]
