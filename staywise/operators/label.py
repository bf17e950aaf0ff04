"""Rule-based churn label, class counts and class weights."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.config import LabelRules
from staywise.functions.rules import as_flag, churn_condition


def churn(df: DataFrame, rules: LabelRules = LabelRules(), out: str = "churn_label") -> DataFrame:
    """Add the 0/1 label. It is a fixed rule over columns the model also sees, so
    model metrics measure how well that rule is recovered."""
    return df.withColumn(out, as_flag(churn_condition(rules)))


def counts(df: DataFrame, label: str = "churn_label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def balance(df: DataFrame, label: str = "churn_label", n: str | None = None) -> DataFrame:
    """One row ``neg, pos, balance_ratio``; a class without rows counts as one row
    in the ratio. ``n`` names a count column if ``df`` is aggregated already."""
    rows = F.lit(1) if n is None else F.col(n)

    def total(value):
        return F.coalesce(F.sum(F.when(F.col(label) == value, rows)), F.lit(0))

    def at_least_one(column):
        return F.greatest(F.col(column), F.lit(1)).cast("double")

    return df.agg(total(0).alias("neg"), total(1).alias("pos")).withColumn(
        "balance_ratio", at_least_one("neg") / at_least_one("pos")
    )


def weight(
    df: DataFrame,
    ratio: float | None = None,
    label: str = "churn_label",
    out: str = "class_weight",
) -> DataFrame:
    """Positives weigh ``ratio``, all other rows 1.0.

    Without a ``ratio`` it is taken from ``df`` itself by a scalar subquery, so the
    counts never pass through the driver program.
    """
    if ratio is None:
        factor = balance(df, label).select("balance_ratio").scalar()
    else:
        factor = F.lit(float(ratio))
    return df.withColumn(out, F.when(F.col(label) == 1, factor).otherwise(F.lit(1.0)))
