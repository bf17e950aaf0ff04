"""A look at a table: per-column profile and ordered first rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.workspace import cut_lineage


def distinct_counts(df: DataFrame, columns) -> DataFrame:
    """``column, distinct_values``, exact, for flat columns of a stored table.

    Each column is read by itself, and its equal values are combined before they move.
    """
    each = [
        df.select(c).distinct().agg(F.lit(c).alias("column"), F.count(c).alias("distinct_values"))
        for c in columns
    ]
    return reduce(DataFrame.unionAll, each)


def profile(df: DataFrame, columns=None, exact: bool = False) -> DataFrame:
    """One row per column: ``column, type, non_null, distinct_values, min, max``.

    One scan; distinct values are estimated by a sketch per column. ``exact`` counts them
    from a stored copy. Minimum and maximum are taken in the column's own type and shown as
    text.
    """
    columns = list(columns or df.columns)
    if exact:
        df = cut_lineage(df.select(*columns))
    totals = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.min(c).cast("string").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("string").alias(f"hi_{c}") for c in columns],
        *([] if exact else [F.approx_count_distinct(c).alias(f"d_{c}") for c in columns]),
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("type"),
            F.col(f"n_{c}").alias("non_null"),
            *([] if exact else [F.col(f"d_{c}").alias("distinct_values")]),
            F.col(f"lo_{c}").alias("min"),
            F.col(f"hi_{c}").alias("max"),
        )
        for c in columns
    ]
    found = totals.select(F.inline(F.array(*entries)))
    if exact:
        # Both sides have one row per column of ``df``.
        found = found.join(distinct_counts(df, columns), "column")
    return found.select("column", "type", "non_null", "distinct_values", "min", "max")


def head(df: DataFrame, n: int = 10, order=()) -> DataFrame:
    """The first ``n`` rows in a stated order; a top-n, not a full sort."""
    return df.orderBy(*(order or df.columns)).limit(n)
