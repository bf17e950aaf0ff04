"""Streams: restarts, late files, fan-out, running lanes, failures."""

import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from staywise import sinks, sources
from staywise.operators import gold
from staywise.plans import fixture
from staywise.schemas import GOLD_SCORING, KAFKA, STAMPED_EVENT
from staywise.sinks import file_tables as file_sinks
from staywise.sinks import kafka_topics as kafka_sink
from staywise.sinks.file_tables import DRAIN
from staywise.sources import kafka_topics as kafka_source
from staywise.streaming import control, medallion, scorer


@pytest.fixture
def topic(spark, sf_dir, tmp_path):
    """Messages in the place of a topic; returns the folder and a way to add more."""
    path = str(tmp_path / "topic")
    messages = fixture.scoring_messages(spark, sf_dir)
    messages.where("offset < 600").write.parquet(path)

    def more():
        messages.where("offset >= 600").write.mode("append").parquet(path)

    return path, more


def lane(spark, topic_path, root, **options):
    stream = sources.files_stream(spark, topic_path, KAFKA)
    return medallion.scoring_lane(
        stream, medallion.LanePaths(root), clock=F.col("timestamp"), **options
    )


def test_restart_adds_nothing_and_late_files_count_once(spark, topic, tmp_path):
    path, more = topic
    root = str(tmp_path / "lane")

    def rows():
        return spark.read.schema(GOLD_SCORING).parquet(f"{root}/gold").count()

    lane(spark, path, root)
    first = rows()
    lane(spark, path, root)
    assert rows() == first == 600
    more()
    lane(spark, path, root)
    lane(spark, path, root)
    assert rows() == 1000


def test_small_batches_give_the_same_rows(spark, topic, tmp_path):
    path, more = topic
    more()
    spark.read.parquet(path).repartition(6).write.parquet(str(tmp_path / "many"))
    root = str(tmp_path / "lane")
    lane(spark, str(tmp_path / "many"), root, fmt="json", maxFilesPerTrigger=1)
    assert spark.read.schema(GOLD_SCORING).json(f"{root}/gold").count() == 1000


def wait_for(condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


def test_hops_run_side_by_side(spark, topic, tmp_path):
    path, more = topic
    root = str(tmp_path / "lane")
    published = str(tmp_path / "published")

    def publish(messages):
        return sinks.files_stream(messages, published, str(tmp_path / "cp"))

    queries = lane(
        spark, path, root, trigger={"processingTime": "0 seconds"}, publish=[publish]
    )
    try:
        assert len(queries) == 4 and all(q.isActive for q in queries)

        def seen(n):
            def check():
                try:
                    table = spark.read.schema(GOLD_SCORING).parquet(f"{root}/gold").count()
                    texts = spark.read.schema("value string").parquet(published).count()
                except Exception:
                    return False
                return table == texts == n

            return check

        assert wait_for(seen(600))
        more()
        assert wait_for(seen(1000))
    finally:
        control.stop_all(queries)
    control.await_all(queries)


def test_training_lane_runs_side_by_side(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    fixture.dirty_messages(spark, sf_dir).write.parquet(path)
    paths = medallion.LanePaths(str(tmp_path / "lane"))
    stream = sources.files_stream(spark, path, KAFKA)
    queries = medallion.training_lane(stream, paths, trigger={"processingTime": "0 seconds"})
    try:
        assert wait_for(lambda: medallion.training_gold(spark, paths).count() == 1000)
    finally:
        control.stop_all(queries)
    # A malformed message keeps its row and takes the last branch of every rule.
    lost = spark.read.parquet(paths.table("gold")).where("customer_id IS NULL")
    assert lost.count() == 20
    assert lost.select("tenure_bucket", "charge_bucket", "is_high_support").distinct().collect() == [
        ("loyal", "high", 0)
    ]


def test_one_failure_stops_the_rest(spark, topic, tmp_path):
    path, _ = topic
    stream = sources.files_stream(spark, path, KAFKA)
    good = sinks.files_stream(stream, str(tmp_path / "good"), str(tmp_path / "cp1"))
    bad = sinks.files_stream(
        stream.select(F.raise_error(F.lit("broken on purpose")).alias("x")),
        str(tmp_path / "bad"),
        str(tmp_path / "cp2"),
    )
    bystander = sinks.files_stream(stream, str(tmp_path / "other"), str(tmp_path / "cp3"))
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        control.await_all([good, bad], poll=1)
    assert not good.isActive and not bad.isActive and bystander.isActive
    bystander.stop()


def test_fan_out_stops_what_it_started(spark, topic, tmp_path):
    path, _ = topic
    stream = sources.files_stream(spark, path, KAFKA)
    started = []

    def works(df):
        started.append(sinks.files_stream(df, str(tmp_path / "a"), str(tmp_path / "cp")))
        return started[0]

    def fails(df):
        raise RuntimeError("no such sink")

    with pytest.raises(RuntimeError):
        sinks.fan_out(stream, [works, fails])
    assert not started[0].isActive


def test_fan_out_sinks_progress_apart(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    rows = fixture.scoring_events(spark, sf_dir).withColumn(
        "ingestion_time", F.col("event_time").cast("timestamp")
    )
    rows.select(*STAMPED_EVENT.fieldNames()).write.parquet(path)
    stream = gold.features(sources.files_stream(spark, path, STAMPED_EVENT))
    table, text = str(tmp_path / "table"), str(tmp_path / "text")

    def to(name, df):
        return file_sinks.files_stream(df, name, name + "-cp", trigger=DRAIN)

    first = sinks.fan_out(stream, [lambda df: to(table, df)])
    [control.drain(q) for q in first]
    both = sinks.fan_out(
        stream, [lambda df: to(table, df), lambda df: to(text, gold.to_message(df))]
    )
    [control.drain(q) for q in both]
    assert spark.read.parquet(table).count() == spark.read.parquet(text).count() == 1000


def feature_messages(spark, sf_dir):
    from staywise.plans.registry import _dirty_stamped

    texts = gold.to_message(gold.features(_dirty_stamped(spark, sf_dir)))
    return texts.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary"),
        F.lit("churn_features").alias("topic"),
        F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def test_streaming_scores_equal_batch_scores(spark, sf_dir, fitted, tmp_path):
    path = str(tmp_path / "features")
    feature_messages(spark, sf_dir).write.parquet(path)
    folders = [str(tmp_path / n) for n in ("scores", "rejects")]

    def to(folder):
        return lambda df: sinks.files_stream(df, folder, folder + "-cp", trigger=DRAIN)

    for _ in range(2):  # the second run finds nothing new
        stream = sources.files_stream(spark, path, KAFKA)
        for query in scorer.stream(stream, fitted.model, *map(to, folders)):
            control.drain(query)
    scores, rejects = (spark.read.parquet(f) for f in folders)
    assert (scores.count(), rejects.count()) == (860, 140)
    features = scorer.read_features(spark.read.schema(KAFKA).parquet(path))
    expected = scorer.scored(features, fitted.model)
    assert scores.exceptAll(expected).count() == expected.exceptAll(scores).count() == 0
    assert rejects.select("offset").distinct().count() == 140
    assert rejects.where(F.size("reject_reasons") == 0).count() == 0


def test_kafka_options():
    assert kafka_source.options("b:9092", "t", "earliest", maxOffsetsPerTrigger=10) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka_source.options("b:9092", "t")["startingOffsets"] == "latest"
    assert kafka_sink.options("b:9092", "t", "/cp") == {
        "kafka.bootstrap.servers": "b:9092",
        "topic": "t",
        "checkpointLocation": "/cp",
    }


def test_kafka_sink_takes_message_columns_only(spark):
    df = spark.createDataFrame([("k", "v", 1)], "key string, value string, n int")
    assert kafka_sink.message_columns(df).columns == ["key", "value"]
    with pytest.raises(ValueError):
        kafka_sink.message_columns(df.select("n"))


def test_kafka_source_asks_for_its_connector(spark):
    try:
        stream = sources.kafka(spark, "nowhere:9092", "t")
    except Exception as error:
        assert "kafka" in str(error).lower()
    else:
        assert stream.isStreaming and stream.columns == KAFKA.fieldNames()


def test_lanes_over_topics(spark, sf_dir, fitted, tmp_path, monkeypatch):
    """The wiring with a folder in the place of each topic."""
    import json

    from staywise.streaming import topics

    broker = tmp_path / "broker"
    fixture.training_messages(spark, sf_dir).write.parquet(str(broker / "churn_events"))
    fixture.scoring_messages(spark, sf_dir).write.parquet(str(broker / "churn_input"))
    asked = {}

    def read(spark, servers, topic, starting, **options):
        asked[topic] = (starting, options)
        return sources.files_stream(spark, str(broker / topic), KAFKA)

    def write(df, servers, topic, checkpoint, trigger):
        shaped = kafka_sink.message_columns(df).select(
            F.lit(None).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        return sinks.files_stream(shaped, str(broker / topic), checkpoint, trigger=trigger)

    monkeypatch.setattr(sources, "kafka", read)
    monkeypatch.setattr(sinks, "kafka", write)
    paths = {n: medallion.LanePaths(str(tmp_path / n)) for n in ("train", "score", "out")}

    topics.training_lane(spark, "b:9092", paths["train"], trigger=DRAIN)
    assert medallion.training_gold(spark, paths["train"]).count() == 1000
    topics.scoring_lane(spark, "b:9092", paths["score"], trigger=DRAIN, maxOffsetsPerTrigger=9)
    for query in topics.score(spark, "b:9092", fitted.model, paths["out"], trigger=DRAIN):
        control.drain(query)
    assert asked == {
        "churn_events": ("earliest", {}),
        "churn_input": ("latest", {"maxOffsetsPerTrigger": 9}),
        "churn_features": ("earliest", {}),
    }
    scores = spark.read.schema(KAFKA).parquet(str(broker / "churn_output"))
    assert scores.count() == 1000
    record = json.loads(bytes(scores.first().value))
    assert set(record) == {"input", "prediction"}
    assert set(record["input"]) == set(GOLD_SCORING.fieldNames())
    assert spark.read.parquet(paths["out"].table("rejects")).count() == 0
