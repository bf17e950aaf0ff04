"""From raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given; its result is
written as Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.llm import mixing, nbsvm, packing, simhash, surrogates
from staywise.llm.common import new_folder, table
from staywise.llm.registry import SURROGATE_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return nbsvm.classify(docs, model).where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints linked by at most 4 differing bits."""
    return simhash.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the new text."""
    replaced = surrogates.replace(docs, SURROGATE_KEY)
    return replaced.withColumn(
        "n_chars", F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        *docs.columns
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document lies in the training sequences, with its ids."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mix", mix),
    ("pack", pack),
]

#: Classifier, fingerprints, surrogates and packing are beyond SQL; tests have brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what the one before has kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
