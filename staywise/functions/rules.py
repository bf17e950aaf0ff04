"""Rule expressions shared by the batch and the streaming lanes."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from staywise.config import FeatureRules, LabelRules


def as_flag(condition: Column) -> Column:
    """1 where the condition is true; 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def bucket(column: str, cuts, rest: str, null_bucket: str | None = None) -> Column:
    """Name of the first cut whose upper bound lies above the value, else ``rest``."""
    value = F.col(column)
    name = F.lit(rest)
    for label, below in reversed(cuts):
        name = F.when(value < below, label).otherwise(name)
    if null_bucket is not None:
        name = F.when(value.isNull(), null_bucket).otherwise(name)
    return name


def feature_columns(rules: FeatureRules) -> dict[str, Column]:
    """The derived gold columns in output order."""
    return {
        "is_payment_risky": as_flag(F.col("late_payments") >= rules.risky_late_payments),
        rules.high_support_name: as_flag(
            F.col("support_tickets") >= rules.high_support_tickets
        ),
        "tenure_bucket": bucket(
            "tenure_months", rules.tenure_cuts, rules.tenure_rest, rules.null_bucket
        ),
        "charge_bucket": bucket(
            "monthly_charges", rules.charge_cuts, rules.charge_rest, rules.null_bucket
        ),
        "engagement_risk_score": F.col("late_payments") + F.col("support_tickets"),
    }


def churn_condition(rules: LabelRules) -> Column:
    """Three-valued: an unknown pattern never makes a row positive by itself."""
    tickets = F.col("support_tickets")
    patterns = [
        (F.col("late_payments") >= rules.late_payments_from)
        & (tickets >= rules.tickets_with_late_payments_from),
        (F.col("tenure_months") < rules.tenure_below)
        & (F.col("monthly_charges") > rules.charges_above),
        (F.col("subscription_type") == rules.fragile_plan)
        & (tickets >= rules.tickets_on_fragile_plan_from),
    ]
    return reduce(or_, patterns)


def class_at(probability: Column, threshold: float, kind: str = "int") -> Column:
    """1 where the probability reaches the threshold, else 0; NaN reaches none."""
    reached = (probability >= F.lit(threshold)) & ~F.isnan(probability)
    return as_flag(reached).cast(kind)
