"""Classifier evaluation as tables: confusion counts, metrics, curve areas."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.functions.rules import class_at
from staywise.operators.running import running_totals
from staywise.workspace import cut_lineage


def classify(
    df: DataFrame,
    threshold: float = 0.4,
    probability: str = "churn_prob",
    out: str = "prediction_custom",
    kind: str = "double",
) -> DataFrame:
    """Add the class at ``threshold``; a null probability is class 0."""
    return df.withColumn(out, class_at(F.col(probability), threshold, kind))


def crosstab(
    df: DataFrame, label: str = "churn_label", prediction: str = "prediction_custom"
) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("count"))


def confusion(
    df: DataFrame, label: str = "churn_label", prediction: str = "prediction_custom"
) -> DataFrame:
    """One row ``TP, TN, FP, FN``; zeros on an empty table."""

    def cell(actual, said):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == said))

    return df.agg(
        cell(1, 1).alias("TP"),
        cell(0, 0).alias("TN"),
        cell(0, 1).alias("FP"),
        cell(1, 0).alias("FN"),
    )


def _ratio(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def metrics(matrix: DataFrame) -> DataFrame:
    """The confusion row with its derived metrics; 0.0 where a ratio has no base."""
    tp, tn, fp, fn = (F.col(c) for c in ("TP", "TN", "FP", "FN"))
    precision, recall = F.col("precision_class_1"), F.col("recall_class_1")
    return matrix.select(
        "*",
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision_class_1"),
        _ratio(tp, tp + fn).alias("recall_class_1"),
        _ratio(tn, tn + fp).alias("specificity"),
    ).withColumn("f1_class_1", _ratio(2 * (precision * recall), precision + recall))


def score_counts(df: DataFrame, score: str = "churn_prob", label: str = "churn_label") -> DataFrame:
    """Positives and negatives per distinct score, written once.

    All curve areas follow from this table. Rows are combined before the shuffle, so a
    score shared by very many rows is no hot key. A row without a score is below every score,
    as ``classify`` has it in class 0 at every threshold.
    """
    known = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    counted = (
        df.where(F.col(label).isin(0, 1))
        .groupBy(known.alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
        )
    )
    return cut_lineage(counted)


def curve(counted: DataFrame, ranges: int | None = None) -> DataFrame:
    """``score_counts`` with ``tp`` and ``fp``: hits at or above each score."""
    return running_totals(counted, "score", {"tp": "pos", "fp": "neg"}, ranges)


def areas(counted: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row ``roc_auc, pr_auc``, exact and unweighted.

    Trapezoids between neighbouring distinct scores. The precision-recall curve starts
    at recall 0 with the precision of its first point. Both are 0.0 when a class is
    absent.
    """
    points = curve(counted, ranges)
    tp, fp = F.col("tp"), F.col("fp")
    tp_before, fp_before = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    precision_before = F.coalesce(F.try_divide(tp_before, tp_before + fp_before), precision)
    sums = points.agg(
        F.sum(F.col("neg") * (tp_before + F.col("pos") / 2.0)).alias("roc"),
        F.sum(F.col("pos") * (precision + precision_before) / 2.0).alias("pr"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    return sums.select(
        F.when(both, F.col("roc") / (p * n)).otherwise(0.0).alias("roc_auc"),
        F.when(both, F.col("pr") / p).otherwise(0.0).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, score="churn_prob", label="churn_label", ranges: int | None = None) -> DataFrame:
    return areas(score_counts(df, score, label), ranges).select("roc_auc")


def pr_auc(df: DataFrame, score="churn_prob", label="churn_label", ranges: int | None = None) -> DataFrame:
    return areas(score_counts(df, score, label), ranges).select("pr_auc")


def mllib_area(
    df: DataFrame,
    metric: str = "areaUnderROC",
    raw: str = "rawPrediction",
    label: str = "churn_label",
    bins: int = 1000,
) -> float:
    """MLlib's own area; it thins the curve to ``bins`` points, 0 keeps all."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName=metric, numBins=bins
    ).evaluate(df)
