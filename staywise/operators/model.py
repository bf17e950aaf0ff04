"""Split, fit, save and load the churn classifier."""

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.config import ModelSpec
from staywise.operators import encode


Key = str | Column | Sequence[str] | None

#: The default key: all columns of a row.
WHOLE_ROW = ()


def in_training(df: DataFrame, key: Key = WHOLE_ROW, percent: int = 80) -> Column:
    """Whether a row belongs to the training part: a pure function of its key, so it
    holds across partitionings and reruns.

    Named columns are hashed; where all of them are null, the whole row is. An expression
    gives the place among 100 itself, for callers with a numbering of their own.
    """
    if isinstance(key, Column):
        return F.coalesce(F.pmod(key, F.lit(100)) < percent, F.lit(False))
    names = [key] if isinstance(key, str) else list(key)
    place = F.xxhash64(*df.columns)
    if names:
        known = F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()
        place = F.when(known, F.xxhash64(*names)).otherwise(place)
    return F.pmod(place, F.lit(100)) < percent


def split(
    df: DataFrame, key: Key = WHOLE_ROW, spec: ModelSpec = ModelSpec()
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``. With ``None`` as the key the split is random: seeded, yet
    dependent on how the rows are partitioned."""
    if key is None:
        share = spec.train_percent / 100
        train, test = df.randomSplit([share, 1 - share], seed=spec.seed)
        return train, test
    inside = in_training(df, key, spec.train_percent)
    return df.where(inside), df.where(~inside)


def classifier(spec: ModelSpec = ModelSpec()) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol=spec.label,
        weightCol=spec.weight,
        maxIter=spec.max_iter,
        aggregationDepth=spec.aggregation_depth,
    )


def train(
    df: DataFrame, spec: ModelSpec = ModelSpec(), counted: DataFrame | None = None
) -> PipelineModel:
    """Fit on labelled, weighted rows without null numbers.

    ``counted`` are the category counts of ``df`` if they are known already. Only the
    model's columns are read. The solver reads its rows twice before it keeps its own blocks
    of them between iterations, so their vectors are kept on disk until it is done.
    """
    if counted is None and spec.hash_width is None:
        counted = encode.category_counts(df, spec.categorical)
    rows = df.select(*spec.inputs, spec.label, spec.weight)
    encoder = Pipeline(stages=encode.stages(counted, spec)).fit(rows)
    encoded = encoder.transform(rows).select("features", spec.label, spec.weight)
    encoded = encoded.persist(StorageLevel.DISK_ONLY)
    try:
        return PipelineModel([*encoder.stages, classifier(spec).fit(encoded)])
    finally:
        encoded.unpersist()


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_version(model: PipelineModel, root: str, run_id: str) -> str:
    """Save beside the run it belongs to; never replaces another version."""
    path = f"{root.rstrip('/')}/{run_id}"
    model.write().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
