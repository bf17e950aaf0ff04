"""Third hop: risk features and the outgoing feature message."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.config import FeatureRules
from staywise.functions.rules import feature_columns


def features(df: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Add the feature columns, replacing buckets that are already there.

    A single projection: no shuffle, and the same on a stream.
    """
    return df.withColumns(feature_columns(rules))


def to_message(df: DataFrame, key: str | None = None) -> DataFrame:
    """Whole row as one JSON ``value``; null fields are left out of the text."""
    value = F.to_json(F.struct("*")).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)
