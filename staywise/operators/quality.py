"""Input rules: split rows that keep them from rows that break them."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.config import InputRules


def _fine(df: DataFrame, column: str, rules: InputRules) -> Column:
    """Never unknown: a null is simply not fine, nor is a number without end or none at
    all. Plain comparisons, so that a filter on them reaches the files."""
    value = F.col(column)
    fine = value.isNotNull()
    if dict(df.dtypes).get(column) in ("double", "float"):
        # NaN sorts after all numbers, so it fails the first.
        fine &= (value < float("inf")) & (value > float("-inf"))
    if column in rules.domains:
        fine &= value.isin(*rules.domains[column])
    low, high = rules.ranges.get(column, (None, None))
    if low is not None:
        fine &= value >= low
    if high is not None:
        fine &= value <= high
    return fine


def _ruled(rules: InputRules):
    extra = [c for c in (*rules.domains, *rules.ranges) if c not in rules.required]
    return [*rules.required, *dict.fromkeys(extra)]


def _keeps_all(df: DataFrame, rules: InputRules) -> Column:
    return reduce(and_, [_fine(df, column, rules) for column in _ruled(rules)], F.lit(True))


def check(df: DataFrame, rules: InputRules = InputRules()) -> DataFrame:
    """Add ``reject_reasons``: the offending columns, empty for a valid row."""
    problems = [F.when(~_fine(df, column, rules), column) for column in _ruled(rules)]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*problems)))


def valid(df: DataFrame, rules: InputRules = InputRules()) -> DataFrame:
    """Rows that keep every rule."""
    return df.where(_keeps_all(df, rules))


def rejected(df: DataFrame, rules: InputRules = InputRules()) -> DataFrame:
    """Rows that break a rule, with their reasons."""
    return check(df.where(~_keeps_all(df, rules)), rules)


def split(df: DataFrame, rules: InputRules = InputRules()) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; every row lands in exactly one of the two."""
    return valid(df, rules), rejected(df, rules)


def reason_counts(df: DataFrame, rules: InputRules = InputRules()) -> DataFrame:
    """Rejected rows per offending column. A row with two faults counts in both."""
    return (
        check(df, rules)
        .select(F.explode("reject_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def presence(df: DataFrame, required=InputRules().required) -> DataFrame:
    """Per required field, in how many rows it is present or missing.

    One aggregate row is unpivoted, so the cost is one scan without a wide shuffle.
    A field that is no column at all is missing from every row.
    """
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[
            (F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c)
            for c in required
        ],
    )
    return counts.unpivot("n_rows", list(required), "field", "present").select(
        "field", "present", (F.col("n_rows") - F.col("present")).alias("missing")
    )
