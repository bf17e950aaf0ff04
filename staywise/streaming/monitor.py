"""Counts of a scored stream, kept up to date batch by batch.

Counts are the stream's state; what a batch changes lands under its number, and the table is
the latest row of every key. A repeated batch changes nothing, and readers see the counts as
they were after a whole number of batches.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from staywise.operators import evaluate
from staywise.sinks import batches
from staywise.sinks.file_tables import DRAIN


def count_stream(
    df: DataFrame, keys: list[str], path: str, checkpoint: str, trigger: dict = DRAIN
) -> StreamingQuery:
    """Keep ``count`` per combination of ``keys`` in a landed table at ``path``."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("count"))
    return batches.fan_out_once(
        counted, path, checkpoint, trigger=trigger, mode="update", stateful=True
    )


def latest(spark: SparkSession, path: str, keys: StructType) -> DataFrame:
    """``keys…, count`` after the last whole batch."""
    schema = StructType([*keys.fields, StructField("count", LongType())])
    changes = batches.read(spark, path, schema, keep=("batch_id",))
    return changes.groupBy(*keys.fieldNames()).agg(F.max_by("count", "batch_id").alias("count"))


def confusion(crosstab: DataFrame, label="churn_label", prediction="prediction_custom") -> DataFrame:
    """``TP, TN, FP, FN`` from counts per label and prediction; see ``evaluate.metrics``."""

    def cell(actual, said):
        both = (F.col(label) == actual) & (F.col(prediction) == said)
        return F.coalesce(F.sum(F.when(both, F.col("count"))), F.lit(0))

    return crosstab.agg(
        cell(1, 1).alias("TP"), cell(0, 0).alias("TN"), cell(0, 1).alias("FP"), cell(1, 0).alias("FN")
    )


def metrics(crosstab: DataFrame, label="churn_label", prediction="prediction_custom") -> DataFrame:
    return evaluate.metrics(confusion(crosstab, label, prediction))
