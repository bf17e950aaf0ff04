"""Encoding, splitting, fitting, saving and scoring."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staywise import sources
from staywise.config import EVENT_RULES, ModelSpec
from staywise.functions import rules
from staywise.operators import encode, gold, label, model, score
from staywise.plans import training
from staywise.schemas import SCORING_EVENT
from staywise.sinks import runs

SPEC = ModelSpec()


def test_index_and_onehot_on_nulls_and_unseen(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "v string")
    seen = df.union(spark.createDataFrame([("zz",)], "v string"))
    stages = encode.indexers(encode.category_counts(df, ["v"]), ["v"])
    fitted = Pipeline(stages=[*stages, encode.onehot(["v"])]).fit(df)
    out = fitted.transform(seen).select("v", "v_index", vector_to_array("v_ohe").alias("hot"))
    found = {r.v: (r.v_index, r.hot) for r in out.collect()}
    assert found == {
        "b": (0.0, [1.0, 0.0, 0.0]),
        "a": (1.0, [0.0, 1.0, 0.0]),
        "c": (2.0, [0.0, 0.0, 1.0]),
        None: (3.0, [0.0, 0.0, 0.0]),
        "zz": (3.0, [0.0, 0.0, 0.0]),
    }


def test_labels_equal_the_stock_indexer(gold_table):
    ours = encode.indexers(encode.category_counts(gold_table, SPEC.categorical), SPEC.categorical)
    stock = StringIndexer(
        inputCols=list(SPEC.categorical),
        outputCols=[f"{c}_i" for c in SPEC.categorical],
        handleInvalid="keep",
    ).fit(gold_table)
    assert [list(x.labels) for x in ours] == [list(x) for x in stock.labelsArray]


def test_null_number_raises_in_the_vector(spark, fitted, gold_table):
    broken = gold_table.limit(1).withColumn("late_payments", F.lit(None).cast("int"))
    for vectors in (False, True):
        with pytest.raises(Exception):
            score.batch(broken, fitted.model, vectors=vectors).collect()


def test_split_is_a_partition_of_the_rows(spark, gold_table):
    train, test = model.split(gold_table, F.pmod(F.col("event_id") * 7919, F.lit(100)))
    ids = {r.event_id for r in test.select("event_id").collect()}
    assert train.count() + len(ids) == gold_table.count()
    assert ids == {i for i in range(1000) if i * 7919 % 100 >= 80} & {
        r.event_id for r in gold_table.select("event_id").collect()
    }
    hashed = model.split(gold_table)[1]
    moved = model.split(gold_table.repartition(7))[1]
    assert hashed.exceptAll(moved).count() == moved.exceptAll(hashed).count() == 0


@pytest.mark.parametrize("key", ["id * 100", "-id", "if(id % 2 = 0, null, id)", "cast(null as int)"])
def test_split_is_even_whatever_the_keys(spark, key):
    rows = spark.range(20_000).selectExpr(f"{key} AS event_id", "id AS other")
    train, test = model.split(rows, "event_id")
    assert train.count() + test.count() == 20_000
    assert abs(train.count() / 20_000 - 0.8) < 0.02


def test_an_empty_part_is_an_error(gold_table):
    with pytest.raises(ValueError, match="to test on"):
        training.fit(gold_table, key=F.lit(0))


def test_random_split_covers_all_rows(gold_table):
    train, test = model.split(gold_table, key=None)
    assert train.count() + test.count() == gold_table.count()


def test_fit(fitted):
    classifier = fitted.model.stages[-1]
    assert classifier.numFeatures == 20
    assert classifier.getMaxIter() == 20
    assert fitted.balance_ratio == pytest.approx(683 / 317)


def test_probabilities(fitted, gold_table):
    out = score.batch(gold_table, fitted.model, vectors=True)
    p = vector_to_array("probability")
    bad = out.where(
        (F.abs(p[0] + p[1] - 1) > 1e-12)
        | ~F.col("churn_prob").between(0, 1)
        | (F.col("prediction_custom") != (F.col("churn_prob") >= 0.4).cast("int"))
    )
    assert bad.count() == 0


def _odd_ones(table):
    """With unknown and null categories, and numbers without end."""
    kind = F.col("event_id") % 10
    return table.withColumns(
        {
            "gender": F.when(kind == 1, "Other").otherwise(F.col("gender")),
            "location": F.when(kind != 2, F.col("location")),
            "charge_bucket": F.when(kind == 3, "").otherwise(F.col("charge_bucket")),
            "monthly_charges": F.when(kind == 4, float("inf"))
            .when(kind == 5, -1e9)
            .otherwise(F.col("monthly_charges")),
        }
    )


def test_log_odds_are_the_models_own(fitted, gold_table):
    """Scored without a feature vector per row, and as the model's stages score."""
    table = _odd_ones(gold_table)
    ours = score.batch(table, fitted.model, trust_buckets=True, raw=True)
    theirs = score.batch(table, fitted.model, trust_buckets=True, vectors=True, raw=True)
    assert "UDF" in theirs._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in ours._jdf.queryExecution().executedPlan().toString()
    assert ours.columns == [c for c in theirs.columns if c in ours.columns]
    pairs = ours.alias("a").join(theirs.alias("b"), "event_id")

    def near(column, share):
        a, b = F.col(f"a.{column}"), F.col(f"b.{column}")
        return (a == b) | (F.abs(a - b) <= share * F.greatest(F.abs(b), F.lit(1.0)))

    differs = pairs.where(
        ~near("churn_prob", 1e-12)
        | ~near("churn_raw", 1e-12)
        | (F.col("a.prediction_custom") != F.col("b.prediction_custom"))
    )
    assert (pairs.count(), differs.count()) == (1000, 0)


def test_nan_raises_as_in_the_vector(fitted, gold_table):
    broken = gold_table.limit(1).withColumn("monthly_charges", F.lit(float("nan")))
    for vectors in (False, True):
        with pytest.raises(Exception):
            score.batch(broken, fitted.model, vectors=vectors).collect()


def test_rows_are_encoded_once_for_the_solver(gold_table, monkeypatch):
    """The solver reads its rows twice; it is given vectors that are kept."""
    kept, fit = [], LogisticRegression.fit

    def seen(self, rows, *args):
        kept.append((rows, rows.storageLevel.useDisk, rows.columns))
        return fit(self, rows, *args)

    monkeypatch.setattr(LogisticRegression, "fit", seen)
    model.train(label.weight(label.churn(gold_table)))
    ((rows, on_disk, columns),) = kept
    assert on_disk and columns == ["features", SPEC.label, SPEC.weight]
    assert not rows.storageLevel.useDisk


@pytest.mark.parametrize("places", [480, 5000])
def test_many_categories(spark, gold_table, tmp_path, places):
    """Batch and stream score a model with many values of a free-text column."""
    wide = gold_table.withColumn(
        "location", F.concat(F.lit("place "), (F.col("event_id") % places).cast("string"))
    )
    more = wide.unionByName(
        spark.range(places).join(wide.limit(1).drop("location")).select(
            *[c for c in wide.columns if c != "location"],
            F.concat(F.lit("place "), F.col("id").cast("string")).alias("location"),
        )
    )
    path = str(tmp_path / "wide")
    more.write.parquet(path)
    table = spark.read.parquet(path)
    fitted = training.fit(table)
    assert score.batch(table, fitted.model).where("churn_prob between 0 and 1").count() == table.count()
    stream = spark.readStream.schema(table.schema).parquet(path)
    out = str(tmp_path / "out")
    query = (
        score.batch(stream, fitted.model)
        .writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == table.count()


def test_indexing_ranks_no_column_in_one_task(gold_table):
    counted = encode.category_counts(gold_table, SPEC.categorical)
    assert "Window" not in counted._jdf.queryExecution().executedPlan().toString()


def test_nan_reaches_no_threshold(spark):
    df = spark.createDataFrame([(float("nan"),), (0.4,), (None,)], "churn_prob double")
    found = [r[0] for r in df.select(rules.class_at(F.col("churn_prob"), 0.4)).collect()]
    assert found == [0, 1, 0]


def test_lower_threshold_finds_no_fewer(fitted):
    def recall(threshold):
        scored = score.batch(fitted.test, fitted.model, threshold)
        return scored.where("churn_label = 1 AND prediction_custom = 1").count()

    assert recall(0.4) >= recall(0.5)


def test_buckets_are_recomputed_unless_trusted(fitted, spark):
    event = dict(
        gender="Male", location="ASIA", subscription_type="Standard", tenure_months=40,
        monthly_charges=30.0, support_tickets=2, late_payments=1,
        tenure_bucket="new", charge_bucket="high",
    )
    df = sources.rows(spark, [event], SCORING_EVENT)
    ours = score.batch(df, fitted.model).first()
    trusted = score.batch(df, fitted.model, trust_buckets=True).first()
    assert (ours.tenure_bucket, trusted.tenure_bucket) == ("loyal", "new")
    assert not math.isclose(ours.churn_prob, trusted.churn_prob)


def test_output_styles(fitted, gold_table):
    scored = score.batch(gold_table, fitted.model)
    response = score.to_output(scored, "response").first()
    assert response.threshold == 0.4 and response.prediction in (0, 1)
    record = score.to_output(scored).first()
    assert record.input.event_id is not None and record.prediction in (0.0, 1.0)
    with pytest.raises(ValueError):
        score.to_output(scored, "other")


def test_run_is_logged_and_saved(spark, gold_table, tmp_path):
    models, log = str(tmp_path / "models"), str(tmp_path / "log")
    first = training.run(gold_table, models, log)
    second = training.run(gold_table, models, log, balance_on="train", run_name="other")
    entries = runs.read(spark, log)
    assert entries.groupBy("run_id").count().count() == 2
    mine = {r.key: r.value for r in entries.where(F.col("run_id") == first.run_id).collect()}
    assert mine["maxIter"] == "20" and mine["threshold"] == "0.4"
    assert float(mine["balance_ratio"]) == first.fitted.balance_ratio
    cells = sum(int(mine[c]) for c in ("TP", "TN", "FP", "FN"))
    assert cells == first.fitted.test.count()
    assert 0.9 < float(mine["roc_auc"]) <= 1.0
    loaded = model.load(mine["model_path"])
    assert loaded.stages[-1].coefficients == first.fitted.model.stages[-1].coefficients
    assert second.model_path != first.model_path
    assert second.fitted.balance_ratio != first.fitted.balance_ratio


def test_save_overwrites(fitted, gold_table, tmp_path):
    path = str(tmp_path / "model")
    model.save(fitted.model, path)
    model.save(fitted.model, path)
    one = gold_table.limit(1)
    assert score.batch(one, model.load(path)).first() == score.batch(one, fitted.model).first()


def test_training_keeps_what_the_encoder_can_hold(gold_table, fitted):
    other = gold_table.withColumn(
        "gender", F.when(F.col("event_id") % 10 == 0, "Other").otherwise(F.col("gender"))
    )
    kept = training.fit(other)
    assert kept.n_rejected == 0 and kept.balance_ratio == fitted.balance_ratio
    strict = training.fit(other, rules=EVENT_RULES)
    assert strict.rejected == {"gender": 100} and strict.n_rows == 1000
    kind = F.col("event_id") % 50
    broken = gold_table.withColumn("late_payments", F.when(kind != 2, F.col("late_payments")))
    broken = broken.withColumn(
        "monthly_charges", F.when(kind == 3, float("nan")).otherwise(F.col("monthly_charges"))
    )
    again = training.fit(broken)
    assert again.rejected == {"late_payments": 20, "monthly_charges": 20}
    assert (again.n_train, again.n_test) == (again.train.count(), again.test.count())
    assert again.n_train + again.n_test == 960


def test_report_matches_mllib(fitted):
    from staywise.operators import evaluate

    scored = score.batch(fitted.test, fitted.model, vectors=True, raw=True)
    row = training.report(scored).first()
    for metric, name in (("areaUnderROC", "roc_auc"), ("areaUnderPR", "pr_auc")):
        assert row[name] == pytest.approx(evaluate.mllib_area(scored, metric, bins=0), abs=1e-9)
    cells = evaluate.confusion(scored).first()
    assert tuple(row)[:4] == tuple(cells)


def test_weights_reach_the_solver(gold_table, fitted):
    flat = label.weight(label.churn(model.split(gold_table)[0]), 1.0)
    plain = model.train(flat)
    found = [
        score.batch(fitted.test, m).where("prediction_custom = 1").count()
        for m in (plain, fitted.model)
    ]
    assert found[0] < found[1]


def test_gold_features_are_what_the_model_reads(gold_table):
    assert set(SPEC.inputs) <= set(gold.features(gold_table).columns)
