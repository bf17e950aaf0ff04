"""Plans that must hold on large and lopsided data."""

import shutil

import pytest
from pyspark.sql import functions as F

from staywise.operators import bronze, evaluate, quality, silver
from staywise.plans import fixture, registry
from staywise.streaming import scorer

STREAMS_OR_MODELS = (
    "src_", "sink_", "medallion", "gold_stream", "train_", "score_", "rows_", "run_log", "stream_",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def setting(spark):
    old = {}

    def change(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", sorted(n for n in registry.QUERIES if not n.startswith(STREAMS_OR_MODELS))
)
def test_no_pair_joins_and_no_python(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert banned not in text


def test_a_key_with_a_third_of_the_events_is_split(spark, sf_dir, setting, tmp_path):
    for name in ("customer", "nation", "region"):
        shutil.copy(f"{sf_dir}/{name}.parquet", tmp_path)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    copies.withColumn("user_id", hot.cast("bigint")).drop("copy").repartition(16).write.parquet(
        str(tmp_path / "events.parquet")
    )
    expected = fixture.customer_events(spark, str(tmp_path))
    expected = expected.groupBy("location", "subscription_type").count().collect()

    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    joined = fixture.customer_events(spark, str(tmp_path))
    found = joined.groupBy("location", "subscription_type").count()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected))
    text = plan(found)
    assert "SortMergeJoin(skew=true)" in text


def test_large_sides_are_not_broadcast(spark, sf_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "1KB")
    text = plan(fixture.customer_events(spark, sf_dir))
    assert "SortMergeJoin [user_id" in text


def test_text_is_parsed_once_whatever_is_filtered(spark, sf_dir):
    events = fixture.dirty_events(spark, sf_dir)
    messages = fixture.dirty_messages(spark, sf_dir)
    features = scorer.read_features(messages)
    for df in (
        quality.valid(features),
        quality.rejected(features),
        events.where("late_payments > 3 AND gender = 'Male'"),
        quality.reason_counts(events, registry.EVENT_RULES),
    ):
        assert plan(df).count("from_json") == 1


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(registry.gold_label_counts(spark, sf_dir))
    assert "ts:timestamp_ntz" not in text and "event_type" not in text
    assert "c_name" not in text and "c_acctbal" not in text


def test_rules_reach_the_files(gold_table, setting):
    setting("spark.sql.maxMetadataStringLength", "2000")
    text = plan(quality.valid(gold_table))
    for pushed in (
        "In(gender, [Female,Male])",
        "IsNotNull(late_payments)",
        "LessThan(monthly_charges,Infinity)",
    ):
        assert pushed in text


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    for name in ("gold_label_counts", "confusion_matrix", "reject_reasons", "required_fields"):
        assert "partial_" in plan(registry.QUERIES[name](spark, sf_dir))


def test_lanes_do_not_shuffle(spark, sf_dir):
    texts = bronze.decode(fixture.training_messages(spark, sf_dir))
    from staywise.operators import gold, label

    assert "Exchange hash" not in plan(label.churn(gold.features(silver.parse(texts))))


def test_one_score_held_by_most_rows(spark):
    """A hot score is one row after counting; areas equal those of an even spread."""
    df = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0.5 ELSE cast(id % 997 AS double) / 997 END AS churn_prob",
        "cast(id % 997 > 600 AS int) AS churn_label",
    )
    counted = evaluate.score_counts(df)
    assert counted.count() == counted.select("score").distinct().count()
    one, many = (evaluate.areas(counted, n).first() for n in (1, 64))
    assert one.roc_auc == many.roc_auc and one.pr_auc == pytest.approx(many.pr_auc, abs=1e-12)
    assert one.roc_auc == pytest.approx(
        evaluate.mllib_area(df, raw="churn_prob", bins=0), abs=1e-12
    )


@pytest.mark.parametrize(
    "name", ["score_stream", "score_stream_restart", "score_stream_redelivered"]
)
def test_a_scored_streams_events_are_joined_once(spark, sf_dir, name, monkeypatch):
    joined, customer_events = [], fixture.customer_events

    def counted(*args):
        joined.append(args)
        return customer_events(*args)

    monkeypatch.setattr(fixture, "customer_events", counted)
    rows = registry.QUERIES[name](spark, sf_dir).collect()
    assert len(joined) == 1
    assert sum(row["n_rows"] for row in rows) == 1000


def test_stored_gold_is_dealt_out_evenly(spark, sf_dir):
    """Events in one piece do not stay in one: every later step would have a single task."""
    assert fixture.customer_events(spark, sf_dir).rdd.getNumPartitions() == 1
    stored = registry._stored_gold(spark, sf_dir)
    pieces = stored.groupBy(F.input_file_name()).count().collect()
    rows = [piece["count"] for piece in pieces]
    assert sum(rows) == 1000
    assert len(rows) >= spark.sparkContext.defaultParallelism
    assert max(rows) - min(rows) <= 1
