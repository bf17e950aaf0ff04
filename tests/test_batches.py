"""Batches that land once: failures between sinks, restarts, reads of the source, redelivery."""

from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staywise import sinks, sources
from staywise.operators import gold
from staywise.plans import fixture
from staywise.schemas import GOLD_SCORING, KAFKA
from staywise.sinks import batches, kafka_topics
from staywise.sinks.file_tables import DRAIN
from staywise.streaming import medallion, scorer
from staywise.streaming.control import drain

ROW = StructType().add("id", "long").add("drawn", "double")


@pytest.fixture
def source(spark, tmp_path):
    """1,000 rows in five files, read one file a batch with a number drawn for each row."""
    path = str(tmp_path / "source")
    spark.range(1000).repartition(5).write.parquet(path)

    def stream():
        rows = sources.files_stream(spark, path, StructType().add("id", "long"), maxFilesPerTrigger=1)
        return rows.withColumn("drawn", F.rand())

    return path, stream


def rows_of(spark, path):
    return Counter(map(tuple, batches.read(spark, path, ROW).collect()))


def test_sinks_agree_after_failures(spark, source, tmp_path):
    """Each sink fails at another batch; rows are the landed ones though drawn at random."""
    _, stream = source
    paths = [str(tmp_path / n) for n in ("table", "first", "second")]
    fails = {("first", 1), ("second", 1), ("second", 3)}

    def to(name, path):
        inner = batches.to_files(path)

        def sink(rows, batch):
            if (name, batch.number) in fails:
                fails.remove((name, batch.number))
                raise RuntimeError("away")
            inner(rows, batch)

        return sink

    def run():
        both = [to("first", paths[1]), to("second", paths[2])]
        return drain(sinks.fan_out_once(stream(), paths[0], str(tmp_path / "cp"), both, trigger=DRAIN))

    for _ in range(3):
        with pytest.raises(StreamingQueryException, match="away"):
            run()
    run()
    run()
    found = [rows_of(spark, p) for p in paths]
    assert found[0] == found[1] == found[2]
    assert sorted(i for i, _ in found[0]) == list(range(1000))
    numbers = batches.committed(spark, paths[0])
    assert sorted(r.batch_id for r in numbers.collect()) == [0, 1, 2, 3, 4]


def test_the_source_is_read_once_a_batch(source, tmp_path):
    _, stream = source
    into = [batches.to_files(str(tmp_path / n)) for n in "abc"]
    query = drain(
        sinks.fan_out_once(stream(), str(tmp_path / "t"), str(tmp_path / "cp"), into, trigger=DRAIN)
    )
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [200] * 5


def test_a_batch_cut_short_is_replaced(spark, tmp_path):
    path, batch = str(tmp_path / "table"), batches.Batch("q", 0)
    half = spark.range(10).withColumn("drawn", F.lit(0.0))
    # Files without a marker, as a writer that died leaves them.
    half.write.parquet(batch.folder(path))
    assert rows_of(spark, path) == Counter() and not batches.is_committed(spark, path, batch)
    batches.write(half.limit(3), path, batch)
    assert sum(rows_of(spark, path).values()) == 3
    # Whole now: nothing replaces it.
    batches.write(half, path, batch)
    assert sum(rows_of(spark, path).values()) == 3
    # Another query's batch of the same number is another batch.
    batches.write(half, path, batches.Batch("r", 0))
    kept = batches.read(spark, path, ROW, keep=("query_id", "batch_id"))
    assert Counter(r.query_id for r in kept.collect()) == {"q": 3, "r": 10}


def test_reading_before_anything_landed(spark, tmp_path):
    assert batches.read(spark, str(tmp_path / "none"), ROW).collect() == []


def test_batch_header(spark):
    df = spark.createDataFrame([("v", None)], "value string, headers array<struct<key: string, value: binary>>")
    batch = batches.Batch("q", 7)
    for frame in (df, df.select("value")):
        (header,) = kafka_topics.batch_messages(frame, batch).first().headers
        assert (header.key, bytes(header.value)) == ("batch", b"q/7")


def test_lane_with_one_read(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    fixture.scoring_messages(spark, sf_dir).write.parquet(path)
    paths, texts = medallion.LanePaths(str(tmp_path / "lane")), str(tmp_path / "texts")

    def lane(**options):
        stream = sources.files_stream(spark, path, KAFKA)
        return medallion.scoring_lane(stream, paths, clock=F.col("timestamp"), **options)

    for _ in range(2):
        assert len(lane(publish_batches=[batches.to_files(texts, gold.to_message)])) == 3
    table = batches.read(spark, paths.table("gold"), GOLD_SCORING)
    messages = batches.read(spark, texts, StructType().add("value", "string"))
    assert table.count() == messages.count() == 1000
    with pytest.raises(ValueError):
        lane(publish=[lambda df: None], publish_batches=[])


def test_lane_with_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    fixture.scoring_messages(spark, sf_dir).write.parquet(path)
    paths = medallion.LanePaths(str(tmp_path / "lane"))
    stream = sources.files_stream(spark, path, KAFKA)
    medallion.scoring_lane(stream, paths, clock=F.col("timestamp"), partition_by=("gender",))
    files = spark.read.parquet(paths.table("gold")).inputFiles()
    assert {f.split("gender=")[1].split("/")[0] for f in files} == {"Male", "Female"}


def numbered(spark, numbers, partition=0):
    return spark.createDataFrame(
        [(None, f"{n}".encode(), "t", partition, n, None, 0) for n in numbers], KAFKA
    )


@pytest.fixture
def deliver(spark, tmp_path):
    """Deliver messages, then drain a stream of first deliveries; returns the query."""
    path = str(tmp_path / "topic")

    def run(*frames, within="1 hour", clock=None, fail=False):
        for frame in frames:
            frame.write.mode("append").parquet(path)
        first = scorer.first_deliveries(sources.files_stream(spark, path, KAFKA), within, clock=clock)

        def sink(rows, batch):
            if fail:
                raise RuntimeError("away")

        query = sinks.fan_out_once(
            first.select("partition", "offset", F.col("value").cast("string").alias("value")),
            str(tmp_path / "out"), str(tmp_path / "cp"), [sink], trigger=DRAIN, stateful=True,
        )
        return drain(query)

    def seen():
        schema = StructType().add("partition", "integer").add("offset", "long").add("value", "string")
        rows = batches.read(spark, str(tmp_path / "out"), schema).collect()
        return Counter((r.partition, r.offset, r.value) for r in rows)

    return run, seen


def test_redelivered_messages_count_once(spark, deliver):
    run, seen = deliver
    run(numbered(spark, range(50)), numbered(spark, range(0, 50, 2)))
    # A failure after the batch has landed, with the messages in the state store already.
    with pytest.raises(StreamingQueryException, match="away"):
        run(numbered(spark, range(30, 80)), fail=True)
    run(numbered(spark, range(30, 80)), numbered(spark, range(5), partition=1))
    run(numbered(spark, range(90)))
    expected = [(0, n, str(n)) for n in range(90)] + [(1, n, str(n)) for n in range(5)]
    assert seen() == Counter(expected)


def test_messages_without_a_number_are_told_by_value(spark, deliver):
    run, seen = deliver
    bare = spark.createDataFrame(
        [(None, v, "t", None, None, None, 0) for v in (b"a", b"b", b"a")], KAFKA
    )
    run(bare)
    assert seen() == Counter([(None, None, "a"), (None, None, "b")])


def test_memory_of_messages_is_bounded(spark, deliver):
    """With a clock of the messages' own, keys go once the watermark has passed them."""
    run, seen = deliver
    clock = F.timestamp_seconds(1_000_000 + F.col("offset") * 60)
    kept = []
    for begin in range(0, 600, 100):
        query = run(numbered(spark, range(begin, begin + 100)), within="10 minutes", clock=clock)
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(kept) <= 220 and sum(seen().values()) == 600


def test_compaction_keeps_rows_and_followers(spark, source, tmp_path):
    """Fewer files, the same rows; a next hop neither repeats nor loses a batch."""
    path, stream = source
    table, after = str(tmp_path / "table"), str(tmp_path / "next")

    def land():
        drain(sinks.fan_out_once(stream(), table, str(tmp_path / "cp"), trigger=DRAIN))

    def follow(**options):
        sink = [batches.to_files(after)]
        drain(batches.follow(spark, table, ROW, str(tmp_path / "pos"), sink, trigger=DRAIN, **options))

    def files():
        return len(batches.read(spark, table, ROW).inputFiles())

    land()
    follow(maxFilesPerTrigger=2)
    held, before = rows_of(spark, table), batches.read(spark, table, ROW)
    assert files() >= 5 and batches.compact(spark, table, ROW) == 1
    assert files() == 1 and rows_of(spark, table) == held
    assert Counter(map(tuple, before.collect())) == held
    follow()
    assert rows_of(spark, after) == held
    # Batches that land later, one of them cut short, and another compaction.
    spark.range(1000, 1400).repartition(2).write.mode("append").parquet(path)
    land()
    spark.range(7).withColumn("drawn", F.lit(1.0)).write.parquet(batches.Batch("q", 99).folder(table))
    follow()
    more = rows_of(spark, table)
    assert sum(more.values()) == 1400 and not held - more and rows_of(spark, after) == more
    numbers = batches.read(spark, table, ROW, keep=("batch_id",))
    assert numbers.select("batch_id").distinct().count() == 7
    assert files() == 3 and batches.compact(spark, table, ROW) == 2 and files() == 1
    follow()
    assert rows_of(spark, table) == more == rows_of(spark, after)


def test_compacting_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert batches.compact(spark, path, ROW) == 1 and rows_of(spark, path) == Counter()


def test_scoring_topics_with_one_read(spark, sf_dir, tmp_path, monkeypatch):
    """The wiring, with folders in the place of topics."""
    from staywise.streaming import topics

    broker = str(tmp_path / "churn_input")
    fixture.scoring_messages(spark, sf_dir).write.parquet(broker)
    asked, texts = [], str(tmp_path / "texts")

    def to_topic(servers, topic, prepare, **extra):
        asked.append((servers, topic))
        return batches.to_files(texts, prepare)

    monkeypatch.setattr(sources, "kafka", lambda *a, **k: sources.files_stream(spark, broker, KAFKA))
    monkeypatch.setattr(sinks, "kafka_batches", to_topic)
    paths = medallion.LanePaths(str(tmp_path / "lane"))
    topics.scoring_lane(spark, "b:9092", paths, trigger=DRAIN, one_read=True)
    assert asked == [("b:9092", "churn_features")]
    assert batches.read(spark, paths.table("gold"), GOLD_SCORING).count() == 1000
    assert batches.read(spark, texts, StructType().add("value", "string")).count() == 1000
    with pytest.raises(ValueError, match="stands alone"):
        topics.scoring_lane(spark, "b:9092", paths, trigger=DRAIN, one_read=True, partition_by=("gender",))
