"""Category indexing, one-hot encoding and the feature vector."""

import math

from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.config import ModelSpec
from staywise.operators.running import ROWS_PER_RANGE, numbered
from staywise.workspace import cut_lineage


def category_counts(df: DataFrame, columns, n: str | None = None) -> DataFrame:
    """``column, value, n``: rows per value of every column, from one scan.

    Equal value combinations are combined first, so only those are spread out to one
    row per column. ``n`` names a count column if ``df`` is aggregated already.
    """
    rows = F.count("*") if n is None else F.sum(n)
    combinations = df.groupBy(*columns).agg(rows.alias("_n"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        combinations.select("_n", F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.sum("_n").alias("n"))
    )


def labels(counted: DataFrame, columns) -> list[list[str]]:
    """Each column's values, most frequent first, ties by value.

    The values are part of the model and so come to the driver; only they are ordered, and
    only there.
    """
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for row in counted.where(F.col("column").isin(*columns)).collect():
        found[row["column"]].append((-row["n"], row["value"]))
    return [[value for _, value in sorted(found[c])] for c in columns]


def index_table(counted: DataFrame, columns) -> DataFrame:
    """``column, value, index``: the labels as a table, for any number of values.

    All values are numbered in one order, column by column, in ranges side by side; a
    column's first number is taken off. Nothing but one number per column is broadcast.
    """
    wanted = cut_lineage(counted.where(F.col("column").isin(*columns)).select("column", "value", "n"))
    ranges = math.ceil(wanted.count() / ROWS_PER_RANGE) or 1
    placed = numbered(wanted, [F.asc("column"), F.desc("n"), F.asc("value")], ranges)
    first = wanted.groupBy("column").agg(F.count("*").alias("values"))
    earlier = W.partitionBy(F.lit(0)).orderBy("column").rowsBetween(W.unboundedPreceding, -1)
    # One row per column.
    begun = first.select("column", F.coalesce(F.sum("values").over(earlier), F.lit(0)).alias("begin"))
    index = (F.col("number") - F.col("begin")).cast("double").alias("index")
    return placed.join(F.broadcast(begun), "column").select("column", "value", index)


def indexers(counted: DataFrame, columns) -> list[StringIndexerModel]:
    """One indexer per column. Unseen values and nulls share one extra index.

    A single indexer of all columns would do, but PySpark passes label lists of different
    lengths to it with nulls at the end of the shorter ones.
    """
    return [
        StringIndexerModel.from_labels(
            values, inputCol=column, outputCol=f"{column}_index", handleInvalid="keep"
        )
        for column, values in zip(columns, labels(counted, columns), strict=True)
    ]


def onehot(columns) -> OneHotEncoder:
    """One position per known value; unseen values and nulls are all zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
    )


def assembler(spec: ModelSpec = ModelSpec()) -> VectorAssembler:
    """Encoded categories first, then the numbers; a null number raises."""
    encoded = [f"{c}_ohe" for c in spec.categorical]
    if spec.hash_width is not None:
        encoded = ["hashed"]
    return VectorAssembler(inputCols=[*encoded, *spec.numeric], outputCol="features")


def hasher(spec: ModelSpec) -> FeatureHasher:
    """All categories into ``hash_width`` places, by a hash of column and value.

    Needs no list of values, so neither the driver nor the model grows with them. Values may
    share a place; nulls have none.
    """
    return FeatureHasher(
        inputCols=list(spec.categorical), outputCol="hashed", numFeatures=spec.hash_width
    )


def stages(counted: DataFrame | None, spec: ModelSpec = ModelSpec()) -> list:
    """The stages before the classifier; ``counted`` is not needed if categories are hashed."""
    if spec.hash_width is not None:
        return [hasher(spec), assembler(spec)]
    return [
        *indexers(counted, spec.categorical),
        onehot(spec.categorical),
        assembler(spec),
    ]


def positions(df: DataFrame, vector: str, keep=()) -> DataFrame:
    """A vector column in long form: ``keep…, position, value``, zeros included."""
    return df.select(*keep, F.posexplode(vector_to_array(vector)).alias("position", "value"))
