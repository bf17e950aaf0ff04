"""Tables replaced under their readers, counts kept by a stream, sketches, many categories."""

import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException, PySparkException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staywise import sources
from staywise.config import ModelSpec
from staywise.operators import encode, evaluate, sketches
from staywise.plans import training
from staywise.sinks import batches, versions
from staywise.sinks.file_tables import DRAIN
from staywise.streaming import medallion, monitor
from staywise.streaming.control import drain


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_survive_a_replacement(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError, match="no version"):
        versions.read(spark, path)
    assert versions.replace(spark.range(3), path) == 1
    held = versions.read(spark, path)
    bad = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("x"))))
    with pytest.raises(PySparkException):
        versions.replace(bad, path)
    assert ids(versions.read(spark, path)) == [0, 1, 2]
    # A version made from the one before.
    assert versions.replace(versions.read(spark, path).union(spark.range(10, 12)), path) == 2
    assert ids(held) == [0, 1, 2] and ids(versions.read(spark, path)) == [0, 1, 2, 10, 11]
    assert ids(versions.read(spark, path, version=1)) == [0, 1, 2]


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    versions.replace(spark.range(1), path)
    seen = versions.versions(spark, path)
    versions.replace(spark.range(2), path)
    # A writer that looked before the other had committed.
    monkeypatch.setattr(versions, "versions", lambda *_: seen.where("version = 1"))
    with pytest.raises(AnalysisException, match="already exists"):
        versions.replace(spark.range(3), path)
    monkeypatch.undo()
    assert ids(versions.read(spark, path)) == [0, 1]


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(1, 5):
        parted = spark.range(n).withColumn("part", F.col("id") % 2)
        versions.replace(parted, path, partition_by=("part",) if n == 3 else ())
    assert versions.expire(spark, path, keep=2) == [1, 2] and versions.expire(spark, path) == []
    assert ids(versions.read(spark, path)) == [0, 1, 2, 3]
    assert ids(versions.read(spark, path, version=3)) == [0, 1, 2]
    with pytest.raises(ValueError, match="no version 2"):
        versions.read(spark, path, version=2)
    assert versions.replace(spark.range(1), path) == 5
    with pytest.raises(ValueError):
        versions.expire(spark, path, keep=0)


def test_gold_in_versions(spark, sf_dir, tmp_path):
    from staywise.operators import silver
    from staywise.plans import fixture
    from staywise.schemas import CUSTOMER_EVENT

    paths = medallion.LanePaths(str(tmp_path))
    events = silver.conform(fixture.training_events(spark, sf_dir), CUSTOMER_EVENT)
    events.limit(10).write.parquet(paths.table("silver"))
    first = medallion.training_gold(spark, paths, versioned=True)
    events.write.mode("append").parquet(paths.table("silver"))
    assert medallion.training_gold(spark, paths, versioned=True).count() == 1010
    assert first.count() == 10


KEYS = StructType().add("churn_label", "integer").add("prediction_custom", "double")


def test_counts_of_a_stream_after_every_drain(spark, tmp_path):
    """Across restarts and a failure after the batch's counts have landed."""
    rng = random.Random(4)
    staged, table, checkpoint = (str(tmp_path / n) for n in ("rows", "counts", "cp"))
    all_rows = []

    def deliver(n):
        rows = [(rng.randint(0, 1), float(rng.randint(0, 1))) for _ in range(n)]
        all_rows.extend(rows)
        spark.createDataFrame(rows, KEYS).write.mode("append").parquet(staged)

    def run(**options):
        stream = sources.files_stream(spark, staged, KEYS, **options)
        return monitor.count_stream(stream, KEYS.fieldNames(), table, checkpoint)

    for n in (50, 0, 1, 300):
        if n:
            deliver(n)
        drain(run(maxFilesPerTrigger=1))
        found = monitor.latest(spark, table, KEYS)
        batch = evaluate.crosstab(spark.createDataFrame(all_rows, KEYS))
        assert Counter(map(tuple, found.collect())) == Counter(map(tuple, batch.collect()))
        cells = monitor.metrics(found).first()
        expected = evaluate.metrics(evaluate.confusion(spark.createDataFrame(all_rows, KEYS))).first()
        assert cells == expected
    deliver(40)

    def away(rows, batch):
        raise RuntimeError("away")

    stream = sources.files_stream(spark, staged, KEYS).groupBy(*KEYS.fieldNames()).count()
    with pytest.raises(StreamingQueryException, match="away"):
        drain(batches.fan_out_once(
            stream, table, checkpoint, [away], trigger=DRAIN, mode="update", stateful=True
        ))
    drain(run())
    assert sum(r["count"] for r in monitor.latest(spark, table, KEYS).collect()) == len(all_rows) == 391


def test_counts_before_anything_was_counted(spark, tmp_path):
    empty = monitor.latest(spark, str(tmp_path / "none"), KEYS)
    assert tuple(monitor.confusion(empty).first()) == (0, 0, 0, 0)


SCORES = "batch int, churn_prob double, churn_label int"


def drawn(spark, n, kind):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        score = {"normal": rng.gauss(y, 1), "ties": rng.randint(0, 5) + 2.0 * y, "same": 0.0}[kind]
        rows.append((i % 4, None if kind == "ties" and i % 50 == 0 else score, y))
    return spark.createDataFrame(rows, SCORES)


@pytest.mark.parametrize("kind", ["normal", "ties", "same"])
def test_areas_of_sketches_within_the_bound(spark, kind):
    df = drawn(spark, 20_000, kind)
    exact = evaluate.areas(evaluate.score_counts(df)).first()
    stored = sketches.of_classes(df, by=("batch",), size=800)
    found = sketches.areas(sketches.merged(stored, 800)).first()
    assert (found.n_pos, found.n_neg) == (
        df.where("churn_label = 1").count(), df.where("churn_label = 0").count()
    )
    assert abs(found.roc_auc - exact.roc_auc) <= sketches.area_error(800) < 0.01
    assert abs(found.pr_auc - exact.pr_auc) <= 0.02
    # In another order, and sketched at once.
    for other in (stored.orderBy(F.desc("batch")), sketches.of_classes(df, size=800)):
        again = sketches.areas(sketches.merged(other, 800)).first()
        assert abs(again.roc_auc - exact.roc_auc) <= sketches.area_error(800)


def test_areas_of_sketches_without_both_classes(spark):
    df = drawn(spark, 100, "normal")
    for part in (df.where("churn_label = 1"), df.limit(0)):
        row = sketches.areas(sketches.merged(sketches.of_classes(part))).first()
        assert (row.roc_auc, row.pr_auc, row.n_neg) == (0.0, 0.0, 0)


def test_the_bound_falls_with_the_size():
    assert sketches.rank_error(200) == pytest.approx(0.0133, abs=1e-4)
    assert sketches.area_error(4000) < sketches.area_error(400)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 3000])
def test_index_of_very_many_values(spark, monkeypatch, rows_per_range):
    """As many values as rows: numbered on Spark, in the order that the labels have."""
    monkeypatch.setattr(encode, "ROWS_PER_RANGE", rows_per_range)
    df = spark.range(60_000).select(
        F.concat(F.lit("v"), F.col("id") % 20_000 + F.when(F.col("id") < 30_000, 0).otherwise(100_000)).alias("many"),
        (F.col("id") % 3).cast("string").alias("few"),
        F.lit(None).cast("string").alias("none"),
    )
    columns = ["many", "few", "none"]
    counted = encode.category_counts(df, columns)
    found = {}
    for r in encode.index_table(counted, columns).collect():
        found.setdefault(r["column"], {})[r["value"]] = r["index"]
    expected = {
        c: {v: float(i) for i, v in enumerate(values)}
        for c, values in zip(columns, encode.labels(counted, columns), strict=True)
        if values
    }
    assert found == expected and len(found["many"]) == 40_000
    assert encode.index_table(counted.limit(0), columns).collect() == []


def test_training_with_a_million_categories(spark, gold_table):
    """Hashed places only: neither model nor grouping grows with the values."""
    rows = gold_table.crossJoin(spark.range(1000)).withColumn(
        "location", F.concat(F.lit("place "), F.col("customer_id") * 1000 + F.col("id"), F.uuid())
    )
    spec = ModelSpec(hash_width=256, max_iter=5)
    fitted = training.fit(rows.drop("id"), spec=spec)
    assert fitted.model.stages[-1].numFeatures == 260
    assert [type(s).__name__ for s in fitted.model.stages] == [
        "FeatureHasher", "VectorAssembler", "LogisticRegressionModel"
    ]
    assert fitted.n_train + fitted.n_test == fitted.n_rows == 1_000_000


def test_hashed_and_listed_categories_learn_alike(spark, gold_table, tmp_path):
    from staywise.operators import model, score

    areas = []
    for spec in (ModelSpec(), ModelSpec(hash_width=1024)):
        run = training.run(gold_table, str(tmp_path / "m"), str(tmp_path / "l"), spec=spec)
        measured = training.report(training.score_test(run.fitted, spec), spec).first()
        areas.append(measured.roc_auc)
        loaded = score.batch(gold_table, model.load(run.model_path), trust_buckets=True)
        assert loaded.where("churn_prob is null").count() == 0
    assert abs(areas[0] - areas[1]) < 0.01
