"""Curve areas from quantile sketches of the scores, one per class.

A sketch of a batch is made in one pass, stored, and merged with others in any order, so the
areas over all batches so far need no second look at a score.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.operators import evaluate
from staywise.workspace import cut_lineage

#: Size of a sketch; the error of ranks falls about in proportion.
SIZE = 2000
#: Cuts at which the curve is read off.
CUTS = 4000


def rank_error(size: int = SIZE) -> float:
    """How far a rank, as a part of all, may be off, with a probability of 0.99.

    The published bound of KLL sketches for a single rank.
    """
    return 2.296 / size**0.9723


def area_error(size: int = SIZE, cuts: int = CUTS) -> float:
    """How far ``roc_auc`` may be off: a rank in either class and the step between cuts."""
    return 2 * rank_error(size) + 1 / cuts


def of_classes(
    df: DataFrame, score: str = "churn_prob", label: str = "churn_label", size: int = SIZE, by=()
) -> DataFrame:
    """``by…, label, n, sketch`` per class; rows of other labels are left out.

    A null score is below every score, as in ``evaluate``. ``by`` may name a batch.
    """
    known = F.coalesce(F.col(score).cast("double"), F.lit(-1.7976931348623157e308))
    return (
        df.where(F.col(label).isin(0, 1))
        .groupBy(*by, F.col(label).alias("label"))
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double(known, size).alias("sketch"))
    )


def merged(stored: DataFrame, size: int = SIZE) -> DataFrame:
    """``label, n, sketch`` over all stored sketches, in any order."""
    return stored.groupBy("label").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch")
    )


def areas(sketched: DataFrame, cuts: int = CUTS) -> DataFrame:
    """One row ``n_pos, n_neg, roc_auc, pr_auc`` from two rows of ``merged``.

    Each class is stood for by ``cuts`` of its quantiles, each with as much weight as the
    class has rows, and the areas are the exact ones over those. ``area_error`` bounds
    ``roc_auc``; ``pr_auc`` has no stated bound. Both are 0.0 when a class is absent.
    """
    at = F.array(*[F.lit((k + 0.5) / cuts) for k in range(cuts)])
    points = sketched.select(
        "label", "n", F.explode(F.kll_sketch_get_quantile_double("sketch", at)).alias("score")
    )

    def of(label):
        return F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0))

    counted = cut_lineage(points.groupBy("score").agg(of(1).alias("pos"), of(0).alias("neg")))
    found = evaluate.areas(counted, ranges=1)
    return sketched.agg(
        of(1).alias("n_pos"),
        of(0).alias("n_neg"),
    ).select(
        "*",
        found.select("roc_auc").scalar().alias("roc_auc"),
        found.select("pr_auc").scalar().alias("pr_auc"),
    )
