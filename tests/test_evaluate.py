"""Confusion counts, metrics and curve areas against brute force."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staywise.operators import evaluate, profiling
from staywise.operators.running import numbered, running_totals

SCHEMA = "churn_prob double, churn_label int"
PAIRS = st.lists(
    st.tuples(st.sampled_from([0.0, 0.1, 0.25, 0.4, 0.5, 0.9, 1.0]), st.integers(0, 1)),
    min_size=1,
    max_size=40,
)


def brute_roc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return 0.0
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_pr(pairs):
    total = sum(y for _, y in pairs)
    if total in (0, len(pairs)):
        return 0.0
    area, before = 0.0, None
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        hits = [y for s, y in pairs if s >= cut]
        point = (sum(hits) / total, sum(hits) / len(hits))
        before = before or (0.0, point[1])
        area += (point[0] - before[0]) * (point[1] + before[1]) / 2
        before = point
    return area


@settings(max_examples=8, deadline=None)
@given(PAIRS, st.sampled_from([1, 2, 5, 16]))
def test_areas_equal_brute_force(spark, pairs, ranges):
    df = spark.createDataFrame(pairs, SCHEMA)
    row = evaluate.areas(evaluate.score_counts(df), ranges).first()
    assert row.roc_auc == pytest.approx(brute_roc(pairs), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_pr(pairs), abs=1e-12)


def test_areas_depend_on_order_only(spark):
    df = spark.range(500).selectExpr(
        "cast(id * 37 % 101 as double) / 101 AS churn_prob",
        "cast(id * 37 % 101 + id % 40 > 70 as int) AS churn_label",
    )
    moved = df.withColumn("churn_prob", F.exp(F.col("churn_prob") * 5) - 100)
    first = evaluate.areas(evaluate.score_counts(df), 7).first()
    second = evaluate.areas(evaluate.score_counts(moved), 3).first()
    assert first.roc_auc == second.roc_auc
    assert first.pr_auc == pytest.approx(second.pr_auc, abs=1e-12)
    for metric, name in (("areaUnderROC", "roc_auc"), ("areaUnderPR", "pr_auc")):
        whole = evaluate.mllib_area(df, metric, raw="churn_prob", bins=0)
        assert first[name] == pytest.approx(whole, abs=1e-12)


def test_areas_without_both_classes(spark):
    for y in (0, 1):
        df = spark.createDataFrame([(0.1, y), (0.2, y)], SCHEMA)
        assert tuple(evaluate.areas(evaluate.score_counts(df)).first()) == (0.0, 0.0)
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(evaluate.areas(evaluate.score_counts(empty)).first()) == (0.0, 0.0)


def test_running_totals_on_a_lopsided_range(spark):
    """Most values sit close together, one far away; every cut gives the same sums."""
    df = spark.range(2000).selectExpr("1 / (1 + cast(id as double)) AS score", "id % 7 AS n")
    df = df.union(spark.createDataFrame([(1e12, 3)], "score double, n bigint"))
    expected, total = {}, 0
    for row in sorted(df.collect(), key=lambda r: -r.score):
        total += row.n
        expected[row.score] = total
    for ranges in (1, 2, 33, 500):
        found = running_totals(df, "score", {"upto": "n"}, ranges)
        assert {r.score: r.upto for r in found.collect()} == expected
    with pytest.raises(ValueError):
        running_totals(df, "score", {"upto": "n"}, 0)


def test_running_totals_over_many_ranges(spark, monkeypatch):
    """More ranges than one group holds, and more than there are values."""
    from staywise.operators import running

    monkeypatch.setattr(running, "GROUP", 16)
    df = spark.range(3000).selectExpr("cast(id * 7919 % 3001 as double) AS score", "id % 11 AS n")
    rows = sorted(df.collect(), key=lambda r: -r.score)
    expected = dict(zip([r.score for r in rows], itertools.accumulate(r.n for r in rows), strict=True))
    for ranges in (15, 300, 20_000):
        found = running_totals(df, "score", {"upto": "n"}, ranges)
        assert {r.score: r.upto for r in found.collect()} == expected


def test_rows_without_a_score_are_class_0_everywhere(spark):
    """Areas and confusion agree on them: they are below every threshold."""
    pairs = [(0.9, 1), (None, 1), (0.5, 0), (None, 0), (0.4, 1), (0.1, 0), (None, 0)]
    df = spark.createDataFrame(pairs, SCHEMA)
    lowest = [(-1.0 if s is None else s, y) for s, y in pairs]
    row = evaluate.areas(evaluate.score_counts(df), 3).first()
    assert row.roc_auc == pytest.approx(brute_roc(lowest), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_pr(lowest), abs=1e-12)
    cells = evaluate.confusion(evaluate.classify(df)).first()
    assert tuple(cells) == (2, 3, 1, 1) and sum(cells) == len(pairs)
    curve = {r.score: (r.tp, r.fp) for r in evaluate.curve(evaluate.score_counts(df), 2).collect()}
    assert curve[0.4] == (cells.TP, cells.FP) and curve[float("-inf")] == (3, 4)


def test_numbers_of_a_global_order(spark):
    rows = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("x"), F.lit("s").alias("range"), F.lit(-1).alias("number")
    )
    for ranges in (None, 1, 77):
        found = numbered(rows, [F.asc("range"), F.desc("x")], ranges)
        assert found.columns == ["x", "range", "number"]
        assert all(r.number == 4999 - r.x for r in found.collect())
    assert numbered(rows.limit(0), [F.asc("x")]).collect() == []


@settings(max_examples=8, deadline=None)
@given(PAIRS)
def test_confusion_cells_sum_to_rows(spark, pairs):
    df = evaluate.classify(spark.createDataFrame(pairs, SCHEMA))
    cells = evaluate.confusion(df).first()
    assert sum(cells) == len(pairs)
    assert cells.TP == sum(s >= 0.4 and y == 1 for s, y in pairs)
    assert cells.FP == sum(s >= 0.4 and y == 0 for s, y in pairs)


def test_metrics_without_rows_are_zero(spark):
    df = evaluate.classify(spark.createDataFrame([], SCHEMA))
    assert set(evaluate.metrics(evaluate.confusion(df)).first()) == {0, 0.0}


def test_threshold_boundary(spark):
    df = evaluate.classify(spark.createDataFrame([(0.4, 1), (0.3999, 1), (None, 1)], SCHEMA))
    assert [r.prediction_custom for r in df.collect()] == [1.0, 0.0, 0.0]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, -0.0, "a"), (1, 0.0, None), (9, 2.0, None), (10, None, None)],
        "i int, d double, s string",
    )
    found = {r["column"]: tuple(r)[1:] for r in profiling.profile(df).collect()}
    assert found["i"] == ("int", 4, 3, "1", "10")
    assert found["d"][:3] == ("double", 3, 2)
    assert found["s"] == ("string", 1, 1, "a", "a")
    rough = {r["column"]: r.distinct_values for r in profiling.profile(df, exact=False).collect()}
    assert rough == {"i": 3, "d": 2, "s": 1}
    empty = profiling.profile(df.where("i > 99")).where("column = 'i'").first()
    assert tuple(empty)[1:] == ("int", 0, 0, None, None)
