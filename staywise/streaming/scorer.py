"""Feature messages in, scored messages and rejects out."""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staywise.config import InputRules
from staywise.operators import bronze, quality, score, silver
from staywise.schemas import GOLD_SCORING
from staywise.sinks import fan_out, fan_out_once
from staywise.sinks.batches import Sink
from staywise.sinks.file_tables import DRAIN

PROVENANCE = ("topic", "partition", "offset")


def first_deliveries(
    messages: DataFrame, within: str, keys=PROVENANCE, clock: Column | None = None
) -> DataFrame:
    """Messages without those that were delivered before, ``within`` their first arrival.

    A message is told by ``keys``; one that lacks any of them by its value as well. What is
    kept in the state store is one short key per message of the last ``within``. The clock is
    the arrival, which never runs backwards, so no message is ever too late and lost;
    another ``clock`` drops messages that are later than ``within`` by it.
    """
    arrival = F.current_timestamp() if clock is None else clock
    lacks = F.lit(False)
    for key in keys:
        lacks = lacks | F.col(key).isNull()
    told = messages.withColumns(
        {"_arrival": arrival, "_told": F.when(lacks, F.col("value"))}
    ).withWatermark("_arrival", within)
    return told.dropDuplicatesWithinWatermark([*keys, "_told"]).drop("_arrival", "_told")


def read_features(messages: DataFrame, keep=PROVENANCE) -> DataFrame:
    """Feature messages as typed rows, with the message they came from."""
    return silver.parse(bronze.decode(messages, keep=keep), GOLD_SCORING, keep=keep)


def scored(
    features: DataFrame,
    model: PipelineModel,
    threshold: float = 0.4,
    rules: InputRules = InputRules(),
) -> DataFrame:
    """Valid rows as ``{input, prediction}`` records."""
    rows = quality.valid(features, rules)
    return score.to_output(
        score.batch(rows, model, threshold),
        "event",
        event=GOLD_SCORING.fieldNames(),
    )


def rejected(features: DataFrame, rules: InputRules = InputRules()) -> DataFrame:
    """Rows that cannot be scored, with their reasons; none is lost."""
    return quality.rejected(features, rules)


def stream(
    messages: DataFrame,
    model: PipelineModel,
    to_scores: Callable[[DataFrame], StreamingQuery],
    to_rejects: Callable[[DataFrame], StreamingQuery],
    threshold: float = 0.4,
    rules: InputRules = InputRules(),
    redelivery: str | None = None,
) -> list[StreamingQuery]:
    """Score a stream of feature messages. The checkpoint of each sink is its read
    position, so restarts neither lose nor repeat a record in file sinks. With
    ``redelivery``, such as ``"1 hour"``, a message sent again within that time is left out;
    each sink remembers messages for itself."""
    if redelivery is not None:
        messages = first_deliveries(messages, redelivery)
    features = read_features(messages)
    return fan_out(
        features,
        [
            lambda df: to_scores(scored(df, model, threshold, rules)),
            lambda df: to_rejects(rejected(df, rules)),
        ],
    )


def stream_once(
    messages: DataFrame,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    to_scores: Sink,
    to_rejects: Sink,
    threshold: float = 0.4,
    rules: InputRules = InputRules(),
    redelivery: str | None = None,
    fmt: str = "parquet",
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Score with one read of the messages, and one memory of those seen, for both sinks.

    Parsed features land at ``path``; scores and rejects are made from what has landed.
    """
    if redelivery is not None:
        messages = first_deliveries(messages, redelivery)
    return fan_out_once(
        read_features(messages),
        path,
        checkpoint,
        [
            lambda rows, batch: to_scores(scored(rows, model, threshold, rules), batch),
            lambda rows, batch: to_rejects(rejected(rows, rules), batch),
        ],
        fmt,
        trigger,
        stateful=redelivery is not None,
    )
