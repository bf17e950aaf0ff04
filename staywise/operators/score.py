"""Scoring tables and streams with a fitted pipeline."""

from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.config import FeatureRules
from staywise.operators import gold
from staywise.operators.evaluate import classify

_BY_MODEL = ("rawPrediction", "probability", "prediction")

#: A column with more known values than this is looked up by the model's own stages.
_LISTED_VALUES = 100


def probability(df: DataFrame, vector: str = "probability", out: str = "churn_prob") -> DataFrame:
    """Probability of the positive class as a plain number."""
    return df.withColumn(out, F.get(vector_to_array(vector), F.lit(1)))


def _number(column: str) -> Column:
    """A number as it enters a feature vector, which takes neither null nor NaN."""
    value = F.col(column).cast("double")
    missing = F.raise_error(F.lit(f"null or NaN in {column}")).cast("double")
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(value)


def log_odds(model: PipelineModel) -> Column | None:
    """The log-odds of ``model`` as an expression of its input columns.

    It adds up what the model's stages add up, in their order: one coefficient per column's
    value, nothing for a value unknown or null, and one per number. None if the model has
    other stages than ``encode.stages`` lists for categories, or columns of many values.
    """
    labels, terms = {}, {}
    *encoders, classifier = model.stages
    inputs = []
    for stage in encoders:
        if isinstance(stage, StringIndexerModel) and stage.isSet("inputCol"):
            if stage.getHandleInvalid() != "keep" or len(stage.labels) > _LISTED_VALUES:
                return None
            labels[stage.getOutputCol()] = (stage.getInputCol(), list(stage.labels))
        elif isinstance(stage, OneHotEncoderModel) and stage.isSet("inputCols"):
            if not stage.getDropLast() or not set(stage.getInputCols()) <= set(labels):
                return None
            terms |= {
                out: labels[column]
                for column, out in zip(stage.getInputCols(), stage.getOutputCols(), strict=True)
            }
        elif isinstance(stage, VectorAssembler) and not inputs:
            inputs = stage.getInputCols()
        else:
            return None
    if not isinstance(classifier, LogisticRegressionModel) or (
        classifier.numClasses != 2 or classifier.coefficientMatrix.numRows != 1
    ):
        return None
    added, weights = [], [float(c) for c in classifier.coefficients]
    if len(weights) != sum(len(terms[c][1]) if c in terms else 1 for c in inputs):
        return None
    for column in inputs:
        if column in terms:
            source, values = terms[column]
            found = F.lit(0.0)
            for value in reversed(values):
                at = weights[values.index(value)]
                found = F.when(F.col(source).cast("string") == value, F.lit(at)).otherwise(found)
            added.append(found)
            weights = weights[len(values) :]
        else:
            added.append(_number(column) * F.lit(weights.pop(0)))
    return reduce(add, [*added, F.lit(float(classifier.intercept))])


def batch(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = 0.4,
    rules: FeatureRules = FeatureRules(),
    trust_buckets: bool = False,
    vectors: bool = False,
    raw: bool = False,
) -> DataFrame:
    """Add ``churn_prob`` and the 0/1 class ``prediction_custom`` at ``threshold``.

    Buckets are recomputed from the numbers unless ``trust_buckets``. Rows must have
    passed ``quality``, as a null number raises.

    ``vectors`` keeps the model's own output columns, for MLlib evaluators; ``raw`` adds
    the log-odds as ``churn_raw``. Without ``vectors`` the log-odds are added up as one
    expression where that can be, as feature vectors cost more than all else in a row.
    """
    if not trust_buckets:
        names = ("tenure_bucket", "charge_bucket")
        recomputed = gold.features(df, rules)
        extra = [c for c in names if c not in df.columns]
        df = recomputed.select(*df.columns, *extra)
    odds = None if vectors else log_odds(model)
    if odds is None:
        scored = probability(model.transform(df))
        scored = probability(scored, "rawPrediction", "churn_raw")
    else:
        # As the model has it: what the other class leaves.
        other = 1 / (1 + F.exp(F.col("churn_raw")))
        scored = df.withColumn("churn_raw", odds).withColumn("churn_prob", 1 - other)
    kept = [*df.columns, *(_BY_MODEL if vectors else ()), *(("churn_raw",) if raw else ())]
    return classify(scored, threshold, kind="int").select(
        *kept, "churn_prob", "prediction_custom"
    )


def to_output(df: DataFrame, style: str = "event", threshold: float = 0.4, event=None) -> DataFrame:
    """Scored rows as outgoing records.

    ``event``: ``input`` (the event columns as one struct) and ``prediction``.
    ``response``: ``churn_probability, prediction, threshold``.
    """
    if style == "event":
        fields = event or [
            c for c in df.columns if c not in ("churn_prob", "prediction_custom")
        ]
        return df.select(
            F.struct(*fields).alias("input"),
            F.col("prediction_custom").cast("double").alias("prediction"),
        )
    if style == "response":
        return df.select(
            F.col("churn_prob").alias("churn_probability"),
            F.col("prediction_custom").cast("int").alias("prediction"),
            F.lit(float(threshold)).alias("threshold"),
        )
    raise ValueError(f"unknown output style: {style}")
