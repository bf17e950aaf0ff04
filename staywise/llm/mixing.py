"""Mix sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order fixed by a keyed hash, repeated
up to ``repeats`` times. A copy's virtual finish time is the source's words up to and with
it, divided by the source's weight. All copies are sorted by that time and taken until the
total budget is reached. A source whose queue runs out stops at its cap and the others go
on in proportion to their weights, so the mix needs no separate sharing out.

Sums over a source are built in two levels: inside buckets of the shuffled order, then over
the buckets. Buckets number about the square root of the documents, so neither level has a
large group, however much of the input one source holds. The sort over virtual time is cut
into ranges in the same way, and only the range that holds the budget's end is sorted.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.llm.common import cut_lineage, words

WEIGHTS = (5, 2, 1)
REPEATS = 3
ADDED = ("size", "source_size", "target", "copies", "taken")


def _order(seed: str, doc_id: str) -> Column:
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def _queued(docs: DataFrame, buckets: int, seed: str, doc_id: str, source: str, text: str):
    """Add size, order and bucket; rises with the order."""
    order = _order(seed, doc_id)
    first = F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint")
    return docs.select(
        "*",
        F.col(source).alias("_source"),
        F.col(doc_id).alias("_id"),
        words(F.col(text)).alias("_size"),
        order.alias("_order"),
        F.shiftright(first * buckets, 32).cast("int").alias("_bucket"),
    )


def sources(sized: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, share: float = 1.0):
    """One row per source: ``_words``, ``_weight``, ``_place``, ``_target``, ``_level``.

    ``_level`` is the virtual time at which the budget is used up. The window holds one row
    per source.
    """
    each = sized.groupBy("_source").agg(
        F.sum("_size").alias("_words"), F.max("_size").alias("_longest")
    )
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("_source"))) - 1
    listed = F.array(*[F.lit(w) for w in weights])
    weighed = each.select(
        "*",
        place.alias("_place"),
        F.element_at(listed, place % len(weights) + 1).cast("bigint").alias("_weight"),
    ).withColumn("_cap", F.col("_words") * repeats)
    everything = W.partitionBy(F.lit(0))
    fuller = everything.orderBy(F.col("_cap") / F.col("_weight"), "_place").rowsBetween(
        W.unboundedPreceding, -1
    )
    before = lambda c: F.coalesce(F.sum(c).over(fuller), F.lit(0))
    budget = F.floor(F.sum("_words").over(everything) * F.lit(share))
    # With the sources up to here at their caps, the level that the others reach; the
    # largest such level is the one that holds.
    level = (budget - before("_cap")) / (F.sum("_weight").over(everything) - before("_weight"))
    leveled = weighed.select("*", budget.alias("_budget"), level.alias("_part"))
    return leveled.select(
        "*", F.max("_part").over(everything).alias("_level")
    ).select(
        "_source", "_words", "_longest", "_weight", "_place", "_budget", "_level",
        F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")).alias("_target"),
    )


def _placed(queued: DataFrame, starts: DataFrame) -> DataFrame:
    """Add ``_upto``, the source's words up to and with the row."""
    inside = (
        W.partitionBy("_source", "_bucket")
        .orderBy("_order", "_id", "_size")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = queued.select("*", F.sum("_size").over(inside).alias("_inside"))
    same = local["_source"].eqNullSafe(starts["_source"]) & (
        local["_bucket"] == starts["_bucket"]
    )
    return local.join(starts, same).select(
        *[local[c] for c in queued.columns],
        *[starts[c] for c in starts.columns if c not in ("_source", "_bucket")],
        (F.col("_inside") + F.col("_start")).alias("_upto"),
    )


def _finish(epoch: int) -> Column:
    return (F.col("_words") * epoch + F.col("_upto")) / F.col("_weight")


def _starts(sized: DataFrame, per_source: DataFrame) -> DataFrame:
    """The words before each bucket of a source, with the source's own figures."""
    sums = sized.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_in"))
    earlier = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_in").over(earlier), F.lit(0))
    begun = sums.select("_source", "_bucket", start.alias("_start"))
    figures = per_source.withColumnRenamed("_source", "_s")
    return begun.join(figures, begun["_source"].eqNullSafe(figures["_s"])).drop("_s")


def _end(placed: DataFrame, repeats: int, ranges: int) -> tuple[float, int] | None:
    """Finish time and source of the last copy within the budget; None if there is none.

    No copy past ``latest`` can be within it: by then each source that has words left is
    past its target, since a queue is never behind by more than its longest document.
    """
    figures = placed.agg(
        F.max("_level").alias("level"),
        F.max("_budget").alias("budget"),
        F.max(F.col("_longest") / F.col("_weight")).alias("late"),
    ).first()
    if not figures.budget:
        return None
    latest = figures.level + figures.late
    copies = placed.where("_size > 0").select(
        "_size",
        "_place",
        F.explode(F.array(*[_finish(e) for e in range(repeats)])).alias("_finish"),
    ).where(F.col("_finish") <= latest)
    ranged = copies.withColumn(
        "_range", F.floor(F.col("_finish") / F.lit(latest) * ranges).cast("int")
    )
    upto = W.partitionBy(F.lit(0)).orderBy("_range")
    sums = ranged.groupBy("_range").agg(F.sum("_size").alias("_in")).select(
        "_range", "_in", F.sum("_in").over(upto).alias("_sum")
    )
    cut = sums.where(F.col("_sum") > figures.budget).orderBy("_range").first()
    if cut is None:
        return math.inf, 0
    left = figures.budget - (cut["_sum"] - cut["_in"])
    inside = W.partitionBy("_range").orderBy("_finish", "_place")
    last = (
        ranged.where(F.col("_range") == cut["_range"])
        .select("_finish", "_place", F.sum("_size").over(inside).alias("_sum"))
        .where(F.col("_sum") <= left)
        .orderBy(F.desc("_finish"), F.desc("_place"))
        .first()
    )
    if last is not None:
        return last["_finish"], last["_place"]
    before = ranged.where(F.col("_range") < cut["_range"])
    last = before.orderBy(F.desc("_finish"), F.desc("_place")).first()
    return (last["_finish"], last["_place"]) if last else None


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    share: float = 1.0,
    seed: str = "mix",
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Each document with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Sizes are words. Sources in order of code points, null last, weigh ``weights``, over and
    over, and share ``share`` of all words; a source gives each document at most ``repeats``
    times. Whole documents are taken, so a source's taken words differ from its target by
    about a document.

    The order depends on ``seed`` and the key alone, so reruns agree. Null and empty texts
    have size 0 and are not taken. Repeated rows are rows of their own; null keys share a
    place in the order. Columns named like the added ones are replaced.
    """
    docs = docs.drop(*ADDED)
    # The user's columns go by their place, so that none is taken for one of those beside
    # them; one by one, so that those that nobody reads do not move.
    names = docs.columns
    docs = docs.select(
        *[F.col(c).alias(f"_kept_{i}") for i, c in enumerate(names)],
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.col(text).alias("text"),
    )
    doc_id, source, text = "doc_id", "source", "text"
    n = docs.count()
    buckets = math.ceil(math.sqrt(n)) or 1
    narrow = docs.select(doc_id, source, text)
    sized = cut_lineage(
        _queued(narrow, buckets, seed, doc_id, source, text).select(
            "_source", "_id", "_size", "_order", "_bucket"
        )
    )
    per_source = cut_lineage(sources(sized, weights, repeats, share))
    starts = cut_lineage(_starts(sized, per_source))
    end = _end(cut_lineage(_placed(sized, starts)), repeats, 2 * buckets)
    placed = _placed(_queued(docs, buckets, seed, doc_id, source, text), starts)
    copies = F.lit(0)
    if end is not None:
        finish, place = end
        for epoch in range(repeats):
            earlier = (_finish(epoch) < finish) | (
                (_finish(epoch) == finish) & (F.col("_place") <= place)
            )
            copies = copies + earlier.cast("int")
    copies = F.when(F.col("_size") > 0, copies).otherwise(0)
    return placed.select(
        *[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(names)],
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        copies.cast("int").alias("copies"),
        (F.col("_size") * copies).alias("taken"),
    )
