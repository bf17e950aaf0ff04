"""Replace a whole table so that its readers never miss it.

Rows are written into a folder of their own and only then become the latest version, by one
small marker. Until that marker is there, and whatever happens to the writer, readers get the
version before; a reader that has begun keeps the files it has found.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

_MARKER = StructType([
    StructField("folder", StringType()),
    StructField("committed_at", StringType()),
    StructField("expired", BooleanType()),
    StructField("version", IntegerType()),
])


def _markers(path: str) -> str:
    return f"{path}-versions"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``folder, committed_at, expired, version``, one row per version."""
    try:
        return spark.read.schema(_MARKER).json(_markers(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MARKER)


def _mark(spark: SparkSession, path: str, version: int, folder: str, expired: bool, mode: str):
    row = spark.range(1).select(
        F.lit(folder).alias("folder"),
        F.current_timestamp().cast("string").alias("committed_at"),
        F.lit(expired).alias("expired"),
    )
    row.coalesce(1).write.mode(mode).json(f"{_markers(path)}/version={version}")


def replace(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), **options
) -> int:
    """Make ``df`` the table's next version and return its number.

    ``df`` may read the table itself. Of two writers at once the one that commits second
    fails, since the other has taken its number, and its rows are no version.
    """
    spark = df.sparkSession
    version = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    folder = f"{path}/data-{uuid.uuid4().hex}"
    writer = df.write.format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(folder)
    _mark(spark, path, version, folder, False, "errorifexists")
    return version


def read(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    version: int | None = None,
) -> DataFrame:
    """The latest version, or the one asked for."""
    found = versions(spark, path).where(~F.col("expired"))
    if version is not None:
        found = found.where(F.col("version") == version)
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"{path} has no {'version' if version is None else f'version {version}'}")
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(row.folder)


def expire(spark: SparkSession, path: str, keep: int = 2, fmt: str = "parquet") -> list[int]:
    """Empty all but the last ``keep`` versions; returns those emptied.

    Call it when no reader of so old a version can still be at work.
    """
    if keep < 1:
        raise ValueError("the latest version cannot expire")
    live = versions(spark, path).where(~F.col("expired"))
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("version")))
    # A handful of rows: versions that have not expired yet.
    old = live.withColumn("place", place).where(F.col("place") > keep).collect()
    for row in old:
        _mark(spark, path, row.version, row.folder, True, "overwrite")
        nothing = spark.createDataFrame([], "expired boolean")
        nothing.write.format(fmt).mode("overwrite").save(row.folder)
    return sorted(row.version for row in old)
