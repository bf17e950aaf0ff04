"""The run log: parameters and metrics of training runs as one growing table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.schemas import RUN_LOG


def entries(df: DataFrame, run_id: str, run_name: str, kind: str) -> DataFrame:
    """A one-row table in long form: one entry per column, values as text."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return texts.unpivot([], texts.columns, "key", "value").select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_name).alias("run_name"),
        F.lit(kind).alias("kind"),
        "key",
        "value",
    )


def params(spark: SparkSession, values: dict, run_id: str, run_name: str) -> DataFrame:
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, RUN_LOG)


def log(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append entries; a run has a few dozen, so one file per call."""
    df.coalesce(1).write.format(fmt).mode("append").save(path)


def read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(RUN_LOG).load(path)
