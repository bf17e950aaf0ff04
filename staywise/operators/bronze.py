"""First hop: message bytes to text, plus the processing-time stamp."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode(df: DataFrame, out: str = "raw_json", keep=()) -> DataFrame:
    """Binary ``value`` as text.

    ``keep`` names message columns (``topic``, ``partition``, ``offset``…) to carry
    along, so that a rejected row can be traced back to its message.
    """
    return df.select(*keep, F.col("value").cast("string").alias(out))


def stamp(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add ``ingestion_time``; one value per batch or micro-batch by default.

    ``clock`` replaces the wall clock, e.g. by the broker's own message time.
    """
    return df.withColumn(
        "ingestion_time", F.current_timestamp() if clock is None else clock
    )
