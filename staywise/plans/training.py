"""From a gold table to a logged, saved model."""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.config import InputRules, LabelRules, ModelSpec
from staywise.operators import encode, evaluate, label, model, quality, score
from staywise.sinks import runs
from staywise.workspace import cut_lineage


@dataclass(frozen=True)
class Fitted:
    """A model, its two parts, and how many rows went where.

    ``rejected`` counts rows left out by the column that kept them out.
    """

    model: PipelineModel
    balance_ratio: float
    train: DataFrame
    test: DataFrame
    n_rows: int
    n_train: int
    n_test: int
    rejected: dict[str, int]

    @property
    def n_rejected(self) -> int:
        return self.n_rows - self.n_train - self.n_test


def _numbers(spec: ModelSpec) -> InputRules:
    """What a feature vector cannot do without: finite numbers."""
    return InputRules(domains={}, required=spec.numeric)


def fit(
    gold: DataFrame,
    key: model.Key = model.WHOLE_ROW,
    spec: ModelSpec = ModelSpec(),
    rules: InputRules | None = None,
    label_rules: LabelRules = LabelRules(),
    balance_on: str = "all",
) -> Fitted:
    """Label, weigh, split and fit ``gold``, best a stored table: it is scanned once for
    counting and once for the solver's own blocks.

    Rows with null or non-finite numbers cannot enter a feature vector; they are counted
    and left out. Unknown categories can, and stay, unless ``rules`` are given, which then
    count as well. One aggregation over categories, label, split part and faults gives the
    class balance, the category indexes and all counts. The balance is taken over all
    rows, or over the training part with ``balance_on="train"``.
    """
    needed = _numbers(spec)
    if rules is not None:
        needed = InputRules(
            rules.domains, tuple(dict.fromkeys((*rules.required, *needed.required))), rules.ranges
        )
    labelled = label.churn(gold, label_rules, spec.label)
    if key is None:
        train, test = model.split(labelled, None, spec)
        parts = train.select("*", F.lit(True).alias("_train")).unionByName(
            test.select("*", F.lit(False).alias("_train"))
        )
    else:
        train, test = model.split(labelled, key, spec)
        inside = model.in_training(labelled, key, spec.train_percent)
        parts = labelled.withColumn("_train", inside)
    # Hashed categories need no counts, and may have too many values to group by.
    listed = () if spec.hash_width is not None else spec.categorical
    grouped = cut_lineage(
        quality.check(parts, needed)
        .groupBy(*listed, spec.label, "_train", "reject_reasons")
        .agg(F.count("*").alias("_n"))
    )
    base = grouped.where("_train") if balance_on == "train" else grouped
    ratio = label.balance(base, spec.label, n="_n").first()["balance_ratio"]
    usable = F.size("reject_reasons") == 0
    total = lambda which: F.coalesce(F.sum(F.when(which, F.col("_n"))), F.lit(0))
    n_rows, n_train, n_test = grouped.agg(
        total(F.lit(True)), total(usable & F.col("_train")), total(usable & ~F.col("_train"))
    ).first()
    if not n_train or not n_test:
        raise ValueError(f"{n_train} rows to train on and {n_test} to test on: choose another key")
    reasons = grouped.select("_n", F.explode("reject_reasons").alias("reason"))
    rejected = {r["reason"]: r["n"] for r in reasons.groupBy("reason").agg(F.sum("_n").alias("n")).collect()}
    counted = None
    if listed:
        counted = encode.category_counts(grouped.where(usable & F.col("_train")), listed, n="_n")
    train, test = quality.valid(train, needed), quality.valid(test, needed)
    weighted = label.weight(train, ratio, spec.label, spec.weight)
    return Fitted(
        model.train(weighted, spec, counted), ratio, train, test, n_rows, n_train, n_test, rejected
    )


def score_test(fitted: Fitted, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """The test part with log-odds, probability and class."""
    return score.batch(
        fitted.test, fitted.model, spec.threshold, trust_buckets=True, raw=True
    )


def report(scored: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """One row of confusion counts, metrics and exact areas from a single scoring pass.

    Rows are counted per log-odds and class; everything else follows from that.
    """
    by_score = cut_lineage(
        scored.groupBy(F.col("churn_raw").alias("score"), "prediction_custom").agg(
            F.count_if(F.col(spec.label) == 1).alias("pos"),
            F.count_if(F.col(spec.label) == 0).alias("neg"),
        )
    )

    def total(column, said):
        part = F.when(F.col("prediction_custom") == said, F.col(column))
        return F.coalesce(F.sum(part), F.lit(0))

    matrix = by_score.agg(
        total("pos", 1).alias("TP"),
        total("neg", 0).alias("TN"),
        total("neg", 1).alias("FP"),
        total("pos", 0).alias("FN"),
    )
    # Two one-row tables side by side.
    area = evaluate.areas(by_score.select("score", "pos", "neg"))
    return evaluate.metrics(matrix).select(
        "*",
        area.select("roc_auc").scalar().alias("roc_auc"),
        area.select("pr_auc").scalar().alias("pr_auc"),
    )


@dataclass(frozen=True)
class Run:
    run_id: str
    model_path: str
    fitted: Fitted


def run(
    gold: DataFrame,
    models: str,
    log: str,
    key: model.Key = model.WHOLE_ROW,
    spec: ModelSpec = ModelSpec(),
    run_name: str = "weighted-logistic",
    run_id: str | None = None,
    **fit_options,
) -> Run:
    """Fit, evaluate, save a model version and append parameters and metrics to the
    run log."""
    spark, run_id = gold.sparkSession, run_id or uuid.uuid4().hex
    fitted = fit(gold, key, spec, **fit_options)
    measured = report(score_test(fitted, spec), spec)
    path = model.save_version(fitted.model, models, run_id)
    params = {
        "model_type": "LogisticRegression",
        "maxIter": spec.max_iter,
        "threshold": spec.threshold,
        "balance_ratio": fitted.balance_ratio,
        "model_path": path,
        "n_rows": fitted.n_rows,
        "n_train": fitted.n_train,
        "n_test": fitted.n_test,
        "n_rejected": fitted.n_rejected,
        **{f"rejected_{column}": n for column, n in sorted(fitted.rejected.items())},
    }
    entries = [
        runs.params(spark, params, run_id, run_name),
        runs.entries(measured, run_id, run_name, "metric"),
    ]
    runs.log(reduce(DataFrame.unionByName, entries), log)
    return Run(run_id, path, fitted)
