"""The lanes and the scorer wired to Kafka topics.

Everything between source and sink is the code that also runs over files; these
functions only choose topics and checkpoints.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery

from staywise import sinks, sources
from staywise.config import FeatureRules, InputRules, Topics
from staywise.operators import gold
from staywise.sinks.file_tables import KEEP_RUNNING
from staywise.streaming import medallion, scorer
from staywise.streaming.medallion import LanePaths


def training_lane(
    spark: SparkSession,
    servers: str,
    paths: LanePaths,
    topics: Topics = Topics(),
    starting: str = "earliest",
    trigger: dict = KEEP_RUNNING,
    fmt: str = "parquet",
    read_options: dict | None = None,
    partition_by=(),
    **kafka_options,
) -> list[StreamingQuery]:
    """Raw customer events into bronze and silver, from the oldest message on.

    ``read_options`` go to the reads between hops, such as ``maxFilesPerTrigger``."""
    messages = sources.kafka(spark, servers, topics.raw_events, starting, **kafka_options)
    return medallion.training_lane(
        messages, paths, fmt, trigger, partition_by, **(read_options or {})
    )


def scoring_lane(
    spark: SparkSession,
    servers: str,
    paths: LanePaths,
    topics: Topics = Topics(),
    starting: str = "latest",
    trigger: dict = KEEP_RUNNING,
    fmt: str = "parquet",
    clock: Column | None = None,
    rules: FeatureRules = FeatureRules(),
    read_options: dict | None = None,
    one_read: bool = False,
    partition_by=(),
    **kafka_options,
) -> list[StreamingQuery]:
    """Scoring events through to the gold table and the feature topic. On the very
    first start only messages from now on are read. ``read_options`` go to the reads
    between hops. ``one_read`` feeds table and topic from one read of each batch."""
    messages = sources.kafka(spark, servers, topics.scoring_events, starting, **kafka_options)

    if one_read:
        to_topic = sinks.kafka_batches(servers, topics.features, gold.to_message)
        return medallion.scoring_lane(
            messages, paths, fmt, trigger, clock, rules,
            publish_batches=[to_topic], partition_by=partition_by, **(read_options or {}),
        )

    def publish(df):
        checkpoint = paths.checkpoint("features-topic")
        return sinks.kafka(df, servers, topics.features, checkpoint, trigger)

    return medallion.scoring_lane(
        messages, paths, fmt, trigger, clock, rules, [publish],
        partition_by=partition_by, **(read_options or {}),
    )


def score(
    spark: SparkSession,
    servers: str,
    model: PipelineModel,
    paths: LanePaths,
    topics: Topics = Topics(),
    starting: str = "earliest",
    threshold: float = 0.4,
    trigger: dict = KEEP_RUNNING,
    fmt: str = "parquet",
    rules: InputRules = InputRules(),
    **kafka_options,
) -> list[StreamingQuery]:
    """Feature topic to score topic; messages that cannot be scored go to a table."""
    messages = sources.kafka(spark, servers, topics.features, starting, **kafka_options)

    def to_scores(df):
        checkpoint = paths.checkpoint("scores-topic")
        return sinks.kafka(gold.to_message(df), servers, topics.scores, checkpoint, trigger)

    def to_rejects(df):
        checkpoint = paths.checkpoint("rejects")
        return sinks.files_stream(df, paths.table("rejects"), checkpoint, fmt, trigger)

    return scorer.stream(messages, model, to_scores, to_rejects, threshold, rules)
