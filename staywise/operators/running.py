"""Running totals and row numbers over a global order without a single-task sort."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staywise.workspace import cut_lineage

#: Ranges are added up in groups of so many, then the groups.
GROUP = 16384
ROWS_PER_RANGE = 1_000_000


def numbered(df: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """Add ``number``, each row's place in ``order`` from 0.

    ``order`` must tell all rows apart and ``df`` be stored, so that a task that is run again
    finds the same rows. Ranges of the order are sorted side by side; only their row counts,
    one per range, are added up in one place. Columns keep any name but ``number``.
    """
    ranges = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = F.monotonically_increasing_id()
    kept = [c for c in df.columns if c != "number"]
    ranged = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    stored = cut_lineage(
        ranged.select(
            F.struct(*kept).alias("row"),
            F.shiftright(placed, 33).cast("int").alias("range"),
            placed.bitwiseAND(F.lit((1 << 33) - 1)).alias("inside"),
        )
    )
    earlier = W.partitionBy(F.lit(0)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    begun = stored.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
    )
    # One row per range.
    return stored.join(F.broadcast(begun), "range").select(
        "row.*", (F.col("begin") + F.col("inside")).alias("number")
    )


def _cut(df: DataFrame, order: str, ranges: int) -> DataFrame:
    """Add ``_range``, rising with ``order``; NaN comes last, as it sorts."""
    cuts = []
    if ranges > 1:
        wanted = [i / ranges for i in range(1, ranges)]
        cuts = df.stat.approxQuantile(order, wanted, 1 / (4 * ranges))
    inner = sorted({c for c in cuts if math.isfinite(c)}) or [0.0]
    cutter = Bucketizer(
        splits=[-math.inf, *inner, math.inf],
        inputCol=order,
        outputCol="_range",
        handleInvalid="keep",
    )
    return cutter.transform(df)


def running_totals(
    df: DataFrame, order: str, totals: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """Add ``{new: source}`` running sums of ``source`` in falling ``order``.

    ``order`` is a double that ``df`` holds each value of once (aggregate first). The
    table is read several times, so it must be written already; see
    ``workspace.cut_lineage``. Rows with a null ``order`` are left out.

    The value range is cut at its quantiles, so every part holds about the same number
    of distinct values no matter how rows are spread. A window runs inside each part,
    and the parts' totals are added up in groups of ``GROUP``, the groups' totals among
    themselves, and joined back. The quantiles only steer the balance; any cut gives the
    same sums.
    """
    df = df.where(F.col(order).isNotNull())
    if ranges is None:
        ranges = math.ceil(df.count() / ROWS_PER_RANGE) or 1
    if ranges < 1:
        raise ValueError("there must be at least one range")
    placed = _cut(df, order, ranges)

    sources = list(dict.fromkeys(totals.values()))
    parts = (
        placed.groupBy("_range")
        .agg(*[F.sum(c).alias(f"_in_{c}") for c in sources])
        .withColumn("_group", F.floor(F.col("_range") / GROUP))
    )

    def above(within, by):
        return W.partitionBy(within).orderBy(F.desc(by)).rowsBetween(W.unboundedPreceding, -1)

    def before(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # One row per group, so one task is enough.
    groups = parts.groupBy("_group").agg(*[F.sum(f"_in_{c}").alias(f"_all_{c}") for c in sources])
    groups = groups.select(
        "_group",
        *[before(f"_all_{c}", above(F.lit(0), "_group")).alias(f"_over_{c}") for c in sources],
    )
    starts = parts.join(groups, "_group").select(
        "_range",
        *[
            (F.col(f"_over_{c}") + before(f"_in_{c}", above("_group", "_range"))).alias(f"_above_{c}")
            for c in sources
        ],
    )
    inside = W.partitionBy("_range").orderBy(F.desc(order)).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    local = placed.select(
        "*", *[F.sum(c).over(inside).alias(f"_upto_{c}") for c in sources]
    )
    # One short row per range; beyond a group's worth Spark chooses the join.
    joined = local.join(F.broadcast(starts) if ranges <= GROUP else starts, "_range")
    added = {
        new: F.col(f"_upto_{source}") + F.col(f"_above_{source}")
        for new, source in totals.items()
    }
    return joined.select(*df.columns, *[e.alias(n) for n, e in added.items()])
