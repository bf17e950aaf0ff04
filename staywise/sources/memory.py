"""A handful of rows from the program itself."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows(spark: SparkSession, records, schema: StructType) -> DataFrame:
    """Dictionaries to a table with a declared schema; absent fields are null."""
    names = schema.fieldNames()
    return spark.createDataFrame([[r.get(n) for n in names] for r in records], schema)
