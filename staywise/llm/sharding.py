"""Shards through fixed virtual slots.

Every record is hashed into one of ``SLOTS`` slots, a number that never changes. A small,
versioned table maps slots to shards: the first version deals them out in turn, each later
one is the version before, edited so that the shards' bytes come out near equal. An edit
keeps each shard's largest slots up to its share and deals what is left over, largest
first, to the shard with the fewest bytes; growing by a shard is such an edit as well. The
map is all that changes; no record is hashed anew.

A slot that holds more than four times its part of all bytes or rows is cut into parts,
which are slots of the map like others, so that neither a key nor a group of equal rows can
outweigh a shard. All steps but the numbering of rows inside a slot move slots, not rows,
and a map has at most ``2 * SLOTS`` of those.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage, new_folder

SLOTS = 4096
SHARDS = 8
#: A slot is cut into parts beyond so many times the mean.
HEAVY = 4
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "version")


def _records(docs: DataFrame, keep, doc_id: str, text: str) -> DataFrame:
    """(kept, size, text_crc32, hash, row, base), stored, so that ``row`` is the same to all."""
    whole = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    # Without columns to keep there is still a struct.
    kept = [F.col(c) for c in keep] or [F.lit(None).cast("int").alias("nothing")]
    return cut_lineage(
        docs.select(
            F.struct(*kept).alias("kept"),
            (F.octet_length(whole) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.xxhash64(key, whole).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("base", F.pmod("hash", F.lit(SLOTS)).cast("int"))
    )


def _weighed(rows: DataFrame, slot: str) -> DataFrame:
    return rows.groupBy(slot).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def _in_slots(records: DataFrame) -> DataFrame:
    """Add ``virtual_slot``: the base slot, plus a multiple of ``SLOTS`` for its later parts."""
    whole = W.partitionBy(F.lit(0))
    share = lambda c: F.ceil(F.col(c) * F.lit(SLOTS / HEAVY) / F.sum(c).over(whole))
    parts = F.least("rows", F.greatest(share("bytes"), share("rows")))
    # At most SLOTS rows.
    heavy = _weighed(records, "base").select("base", parts.alias("parts")).where("parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64("hash", "row"), F.col("parts")), F.lit(0))
    return records.join(F.broadcast(heavy), "base", "left").select(
        *[c for c in records.columns if c != "base"],
        (F.col("base") + part * SLOTS).cast("int").alias("virtual_slot"),
    )


def weights(rows: DataFrame) -> DataFrame:
    """``virtual_slot, bytes, rows`` of rows that have a ``virtual_slot`` and a ``size``."""
    return cut_lineage(_weighed(rows, "virtual_slot"))


def first_map(weighed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``virtual_slot, shard``: slots dealt in turn."""
    return weighed.select(
        "virtual_slot", F.pmod("virtual_slot", F.lit(shards)).cast("int").alias("shard")
    )


def _dealt(shards: int) -> Column:
    """The shards of the slots in ``spare``, in its order: each to the emptiest shard."""
    loads = F.aggregate(
        "fixed",
        F.array_repeat(F.lit(0).cast("bigint"), shards),
        lambda loads, slot: F.transform(
            loads, lambda x, i: x + F.when(i == slot["shard"], slot["bytes"]).otherwise(0)
        ),
    )
    begin = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("to"))

    def deal(state, slot):
        at = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        filled = F.transform(
            state["loads"], lambda x, i: x + F.when(i == at, slot["bytes"]).otherwise(0)
        )
        return F.struct(filled.alias("loads"), F.concat(state["to"], F.array(at)).alias("to"))

    return F.aggregate("spare", begin, deal, lambda state: state["to"])


def rebalanced(slot_map: DataFrame, weighed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map edited for ``weighed``: as few slots as possible move, the smallest ones.

    Slots that the map does not know, or whose shard is no more, are dealt like those left
    over. Slots without rows keep their place if their shard is still there.
    """
    size = F.coalesce("bytes", F.lit(0)).cast("bigint")
    known = slot_map.join(weighed, "virtual_slot", "full").select(
        "virtual_slot", size.alias("bytes"), F.when(F.col("shard") < shards, F.col("shard")).alias("shard")
    )
    upto = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    total = F.sum("bytes").over(W.partitionBy(F.lit(0)))
    stays = F.col("shard").isNotNull() & (F.sum("bytes").over(upto) * shards <= total)
    judged = cut_lineage(known.select("*", stays.alias("stays")))
    slot = F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "bytes", "shard")
    lists = judged.agg(
        F.collect_list(F.when(F.col("stays"), slot)).alias("fixed"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), slot))).alias("spare"),
    )
    moved = lists.select(
        F.inline(F.transform(
            F.arrays_zip(F.col("spare").alias("slot"), _dealt(shards).alias("to")),
            lambda x: F.struct(
                x["slot"]["virtual_slot"].alias("virtual_slot"), x["to"].alias("shard")
            ),
        ))
    )
    return judged.where("stays").select("virtual_slot", "shard").unionByName(moved)


def store(slot_map: DataFrame, folder: str, version: int) -> None:
    """Write the map as a version of its own; versions are never overwritten."""
    slot_map.coalesce(1).write.parquet(f"{folder}/version={version}")


def _maps(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)


def latest(spark: SparkSession, folder: str) -> int:
    """The number of the last version, empty ones included: one file each."""
    files = _maps(spark, folder).inputFiles()
    return max(int(re.search(r"/version=(\d+)/[^/]*$", f)[1]) for f in files)


def stored(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``virtual_slot, shard, version``; the latest version unless another is asked for."""
    version = latest(spark, folder) if version is None else version
    return _maps(spark, folder).where(F.col("version") == version)


def place(
    docs: DataFrame,
    shards: int = SHARDS,
    folder: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row's shard and its place there: the columns ``keep`` and those in ``ADDED``.

    ``size`` is the text's UTF-8 bytes plus 1, ``slot`` the place in the shard, from 0
    without gaps, ``virtual_slot`` the slot that the row was hashed to, ``version`` that of
    the map. The law is ``bytes``: shards differ by no more than the largest slot, which is
    a single record or at most ``2 * HEAVY / SLOTS`` of all bytes. ``grown_shard`` is null.

    With a ``folder`` that holds maps, the latest one is edited and stored as the next
    version; otherwise a first one is, and then its edit.

    Null texts count as empty ones. Null keys, repeated and equal rows are rows of their own
    and may go to different shards. Columns to keep that are named like added ones are
    replaced. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = _in_slots(_records(docs, [c for c in keep if c not in ADDED], doc_id, text))
    weighed = weights(rows)
    if folder is None:
        folder = new_folder(spark, "slots")
        store(first_map(weighed, shards), folder, 1)
    version = latest(spark, folder)
    before = stored(spark, folder, version).drop("version")
    store(rebalanced(before, weighed, shards), folder, version + 1)
    earlier = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    begun = stored(spark, folder, version + 1).join(weighed, "virtual_slot").select(
        "virtual_slot", "shard", "version",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("begin"),
    )
    inside = W.partitionBy("virtual_slot").orderBy("hash", "row")
    # At most 2 * SLOTS rows.
    placed = rows.join(F.broadcast(begun), "virtual_slot")
    return placed.select(
        *[F.col("kept")[c].alias(c) for c in keep if c not in ADDED],
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("begin") + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "version",
    )
