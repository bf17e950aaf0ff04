"""What several operators share: words, held-out rows, tables in the shared folder."""

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.workspace import cut_lineage, new_folder

__all__ = [
    "BLOCK",
    "WORD",
    "cut_lineage",
    "held_out",
    "new_folder",
    "partitions",
    "stored_in_blocks",
    "stored_in_even_blocks",
    "table",
    "unused",
    "words",
]

#: A slot is a long with a block's number above this bit, and below it a count in the block,
#: which is less than the block's bytes.
BLOCK = 32
#: A word is a run of anything but ASCII white space, as ``bytes.split()`` cuts it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether the key's fold is the one kept from training; a null key is not."""
    fold = F.crc32(doc_id.cast("string")) % folds
    return F.coalesce(fold == 0, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(name: str, columns) -> str:
    """``name``, with as many underscores before it as it takes to be none of ``columns``.

    Spark's names do not tell cases apart.
    """
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` stored below the shared folder, dealt by ``block`` into buckets.

    What belongs to a block then joins its rows without moving them. The session can read
    the files by buckets only as a table, which leaves the catalog at once; the files stay.
    """
    spark = rows.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    (
        rows.write.bucketBy(max(1, min(buckets, most)), "block")
        .option("path", new_folder(spark, "blocks"))
        .saveAsTable(name)
    )
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def stored_in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` stored with a ``block`` number, one block per partition of the input."""
    blocks = docs.withColumn("block", F.spark_partition_id().cast("bigint"))
    return _bucketed(blocks, docs.rdd.getNumPartitions())


def stored_in_even_blocks(docs: DataFrame, text: str, size: int) -> DataFrame:
    """``docs`` stored with a ``block`` number; a block has about ``size`` bytes of ``text``.

    Every input partition is dealt into as many blocks as the largest one needs, where a
    text counts as ``size`` at most: one that is longer takes its block over by itself.
    """
    length = F.least(F.coalesce(F.octet_length(text), F.lit(0)), F.lit(size))
    each = docs.groupBy(F.spark_partition_id()).agg(F.sum(length).alias("n"))
    most = each.agg(F.max("n")).first()[0] or 0
    blocks = max(1, math.ceil(most / size))
    inside = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    first = F.spark_partition_id().cast("bigint") * blocks
    return _bucketed(docs.withColumn("block", first + inside), docs.rdd.getNumPartitions())
