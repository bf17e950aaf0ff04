"""File tables, bounded and unbounded."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    **options,
) -> DataFrame:
    """A bounded table.

    Leaving out ``schema`` on JSON costs an extra scan of all files and yields
    ``BIGINT`` integers in alphabetical order; declare it wherever it is known.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def files_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """An unbounded table over a directory; each new file is read once.

    Useful options for long backlogs: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound a micro-batch, ``cleanSource`` archives read files.
    """
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
