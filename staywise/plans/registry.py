"""Every operator as a query over the bundled test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over all rows of the
tables; ``oracle`` holds the same results as SQL. Names and columns match it.
"""

from functools import reduce

from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staywise import sinks, sources
from staywise.config import ALT_SUPPORT_RULES, EVENT_RULES, ModelSpec
from staywise.operators import (
    bronze,
    defects,
    encode,
    evaluate,
    gold,
    label,
    model,
    profiling,
    quality,
    score,
    silver,
    sketches,
)
from staywise.plans import fixture, training
from staywise.schemas import (
    CUSTOMER_EVENT,
    GOLD_SCORING,
    KAFKA,
    SCORING_EVENT,
    STAMPED_EVENT,
)
from staywise.sinks import batches, runs, versions
from staywise.sources import inferred
from staywise.sinks.file_tables import DRAIN
from staywise.streaming import medallion, monitor, scorer
from staywise.streaming.control import await_all, drain
from staywise.workspace import cut_lineage, new_folder

SPEC = ModelSpec()


# Shared pieces


def _gold(spark, sf_dir):
    return gold.features(fixture.customer_events(spark, sf_dir))


def _stored_gold(spark, sf_dir):
    """Gold as a table, which training reads several times.

    Its rows are dealt out evenly first: all later steps read it file by file, and a few
    large files, as the input happens to be cut, would leave cores idle in each of them.
    """
    pieces = 4 * spark.sparkContext.defaultParallelism
    events = fixture.customer_events(spark, sf_dir).repartition(pieces)
    return cut_lineage(gold.features(events))


def _labelled(spark, sf_dir):
    return label.churn(_gold(spark, sf_dir))


def _stamped(spark, sf_dir):
    """Scoring events stamped with the event's own time, so runs are comparable."""
    texts = bronze.decode(fixture.scoring_messages(spark, sf_dir), keep=("timestamp",))
    parsed = silver.parse(texts, SCORING_EVENT, keep=("timestamp",))
    return silver.conform(bronze.stamp(parsed, F.col("timestamp")), STAMPED_EVENT)


def _fixed_scores(spark, sf_dir):
    """A score known without a model: the risk score over its largest value."""
    return _labelled(spark, sf_dir).withColumn(
        "churn_prob", F.col("engagement_risk_score") / 15.0
    )


def _classified(spark, sf_dir):
    return evaluate.classify(_fixed_scores(spark, sf_dir))


def _staged(df: DataFrame, fmt: str = "parquet") -> str:
    """Write a table for a stream to read, in the place of a topic."""
    path = new_folder(df.sparkSession, "staged")
    sinks.files(df, path, fmt)
    return path


def _messages_stream(messages: DataFrame) -> DataFrame:
    return sources.files_stream(messages.sparkSession, _staged(messages), KAFKA)


def _drained(df: DataFrame, fmt: str = "parquet") -> str:
    """Run a stream to its end into a fresh folder."""
    spark = df.sparkSession
    path = new_folder(spark, "drained")
    drain(sinks.files_stream(df, path, new_folder(spark, "checkpoint"), fmt, DRAIN))
    return path


def _naive(df: DataFrame, column: str = "ingestion_time") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def _column(name: str, rules=None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = fixture.customer_events(spark, sf_dir)
        with_features = gold.features(events, rules) if rules else gold.features(events)
        return with_features.select("event_id", name)

    return query


# Sources and sinks


def src_json_stream(spark, sf_dir):
    path = _staged(silver.conform(fixture.training_events(spark, sf_dir), CUSTOMER_EVENT), "json")
    stream = sources.files_stream(spark, path, CUSTOMER_EVENT, "json")
    return sources.files(spark, _drained(stream), schema=CUSTOMER_EVENT)


def src_json_batch_inferred(spark, sf_dir):
    path = _staged(silver.conform(fixture.training_events(spark, sf_dir), CUSTOMER_EVENT), "json")
    return sources.files(spark, path, "json")


def _found_in_two_batches(spark, sf_dir):
    """What two deliveries of JSON files hold; in the second some producers have changed."""
    events = fixture.training_events(spark, sf_dir)
    kind = F.col("event_id") % 50
    changed = silver.conform(events, CUSTOMER_EVENT).columns
    texts = events.select(
        "event_id",
        F.to_json(
            F.struct(
                *[c for c in changed if c not in ("support_tickets", "late_payments")],
                F.when(kind != 1, F.col("support_tickets")).alias("support_tickets"),
                F.when(kind != 5, F.col("late_payments")).alias("late_payments"),
                F.when(kind == 3, F.lit(True)).alias("is_gift"),
            )
        ).alias("value"),
    )
    odd_ones = (
        F.when(kind == 1, F.regexp_replace("value", r"\}$", ',"support_tickets":"many"}'))
        .when(kind == 5, F.regexp_replace("value", r"\}$", ',"late_payments":0.5}'))
        .when(kind == 7, F.regexp_replace("value", r"\}$", ',"note":null}'))
        .when(kind == 9, "no json")
        .otherwise(F.col("value"))
    )
    path, store = new_folder(spark, "json"), new_folder(spark, "fields")
    for half in (0, 1):
        part = texts.where(F.col("event_id") % 2 == half)
        part.select(odd_ones.alias("value")).write.mode("append").text(path)
        inferred.update(spark, path, store)
    return path, inferred.stored(spark, store, keep=("batch_id",))


def src_json_fields(spark, sf_dir):
    """Fields of all files, merged from what is stored of each."""
    return inferred.fields(_found_in_two_batches(spark, sf_dir)[1])


def src_json_drift(spark, sf_dir):
    return inferred.drift(_found_in_two_batches(spark, sf_dir)[1])


def src_json_merged_schema(spark, sf_dir):
    """The files read with the merged schema."""
    path, files = _found_in_two_batches(spark, sf_dir)
    rows = sources.files(spark, path, "json", inferred.schema(files))
    return rows.drop("note")


def sink_json_stream(spark, sf_dir):
    path = _staged(silver.conform(fixture.training_events(spark, sf_dir), CUSTOMER_EVENT))
    stream = sources.files_stream(spark, path, CUSTOMER_EVENT)
    return sources.files(spark, _drained(stream, "json"), "json", CUSTOMER_EVENT)


def sink_json_batch(spark, sf_dir):
    table = gold.features(fixture.training_events(spark, sf_dir))
    return sources.files(spark, _staged(table, "json"), "json", table.schema)


def rows_source(spark, sf_dir):
    """A one-row total, summed up by Spark, as a table made from records."""
    total = fixture.customer_events(spark, sf_dir).agg(
        F.count("*").alias("n_events"),
        F.count_distinct("location").alias("n_locations"),
        F.max("support_tickets").alias("max_tickets"),
    )
    return sources.rows(spark, [total.first().asDict()], total.schema)


# Bronze and silver


def bronze_raw(spark, sf_dir):
    return bronze.decode(fixture.training_messages(spark, sf_dir))


def bronze_ingest_stamp(spark, sf_dir):
    texts = bronze.decode(fixture.scoring_messages(spark, sf_dir))
    stamped = bronze.stamp(silver.parse(texts, SCORING_EVENT))
    return stamped.agg(
        F.count("*").alias("n_rows"),
        F.count("ingestion_time").alias("n_stamped"),
        F.count_distinct("ingestion_time").alias("n_clocks"),
    )


def silver_parsed(spark, sf_dir):
    return fixture.dirty_events(spark, sf_dir)


def silver_conformed(spark, sf_dir):
    return _naive(_stamped(spark, sf_dir))


def _defects(spark, sf_dir):
    texts = bronze.decode(fixture.broken_messages(spark, sf_dir), keep=("offset",))
    return defects.read(texts, CUSTOMER_EVENT, keep=("offset",))


def silver_defects(spark, sf_dir):
    """Every broken message's fields, what is wrong with them, and fields nobody declared."""
    said = F.transform("defects", lambda x: F.concat_ws(":", x["field"], x["state"]))
    return _defects(spark, sf_dir).withColumns(
        {"defects": F.concat_ws(",", said), "unknown": F.concat_ws(",", "unknown")}
    )


def defect_counts(spark, sf_dir):
    return defects.counts(_defects(spark, sf_dir))


def silver_coerced(spark, sf_dir):
    """Inferred integers back to the declared types."""
    inferred = src_json_batch_inferred(spark, sf_dir)
    return silver.coerce(inferred, CUSTOMER_EVENT)


# Gold


def gold_label_counts(spark, sf_dir):
    return (
        _labelled(spark, sf_dir)
        .groupBy("tenure_bucket", "charge_bucket", "churn_label")
        .agg(F.count("*").alias("n"))
    )


def gold_batch(spark, sf_dir):
    return gold.features(fixture.training_events(spark, sf_dir))


def gold_overwrites_buckets(spark, sf_dir):
    featured = gold.features(fixture.scoring_events(spark, sf_dir))
    return featured.select("event_id", *SCORING_EVENT.fieldNames())


def gold_message(spark, sf_dir):
    messages = gold.to_message(gold.features(_stamped(spark, sf_dir)))
    return _naive(silver.parse(messages, GOLD_SCORING, "value"))


def gold_stream(spark, sf_dir):
    path = _staged(_stamped(spark, sf_dir))
    stream = gold.features(sources.files_stream(spark, path, STAMPED_EVENT))
    return _naive(sources.files(spark, _drained(stream), schema=GOLD_SCORING))


def _both_sinks(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of a table and of its messages. Messages carry milliseconds, so both are
    shown at that grain."""
    both = rows.select(F.lit("table").alias("sink"), "*").unionByName(
        silver.parse(texts, GOLD_SCORING, "value").select(F.lit("message").alias("sink"), "*")
    )
    return _naive(both).withColumn(
        "ingestion_time", F.date_trunc("millisecond", "ingestion_time").cast("timestamp_ntz")
    )


def gold_stream_fanout(spark, sf_dir):
    """Table sink and message sink of one stream, both read back."""
    path = _staged(_stamped(spark, sf_dir))
    stream = gold.features(sources.files_stream(spark, path, STAMPED_EVENT))
    table, messages = new_folder(spark, "table"), new_folder(spark, "messages")

    def to(df, folder):
        return sinks.files_stream(df, folder, new_folder(spark, "checkpoint"), trigger=DRAIN)

    for query in sinks.fan_out(
        stream,
        [lambda df: to(df, table), lambda df: to(gold.to_message(df), messages)],
    ):
        drain(query)
    rows = sources.files(spark, table, schema=GOLD_SCORING)
    return _both_sinks(rows, sources.files(spark, messages, schema="value string"))


def gold_fanout_once(spark, sf_dir):
    """Table and messages from one read of each batch; the messages fail once on the way."""
    path = new_folder(spark, "staged")
    sinks.files(_stamped(spark, sf_dir).repartition(3), path)
    table, messages, checkpoint = (new_folder(spark, n) for n in ("table", "messages", "checkpoint"))
    to_messages, tries = batches.to_files(messages, gold.to_message), []

    def unsteady(rows, batch):
        tries.append(batch.number)
        if tries == [0, 1]:
            raise RuntimeError("no messages just now")
        to_messages(rows, batch)

    for last in (False, True):
        stream = sources.files_stream(spark, path, STAMPED_EVENT, maxFilesPerTrigger=1)
        query = sinks.fan_out_once(
            gold.features(stream), table, checkpoint, [unsteady], trigger=DRAIN
        )
        try:
            drain(query)
        except StreamingQueryException:
            if last:
                raise
    return _both_sinks(
        batches.read(spark, table, GOLD_SCORING),
        batches.read(spark, messages, StructType().add("value", "string")),
    )


def gold_compacted(spark, sf_dir):
    """A table that lands in small batches, compacted in between, and its next hop."""
    staged, table, after = (new_folder(spark, n) for n in ("staged", "table", "next"))
    checkpoint, position = new_folder(spark, "checkpoint"), new_folder(spark, "checkpoint")
    rows = _stamped(spark, sf_dir)
    late = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
    for part in (rows.where(late), rows.where(~late)):
        sinks.files(part.repartition(3), staged, mode="append")
        stream = sources.files_stream(spark, staged, STAMPED_EVENT, maxFilesPerTrigger=1)
        drain(sinks.fan_out_once(gold.features(stream), table, checkpoint, trigger=DRAIN))
        to_next = [batches.to_files(after)]
        drain(batches.follow(spark, table, GOLD_SCORING, position, to_next, trigger=DRAIN))
        batches.compact(spark, table, GOLD_SCORING)
    both = [
        batches.read(spark, path, GOLD_SCORING).select(F.lit(sink).alias("sink"), "*")
        for sink, path in (("table", table), ("next", after))
    ]
    return _naive(both[0].unionByName(both[1]))


def medallion_lane_a(spark, sf_dir):
    paths = medallion.LanePaths(new_folder(spark, "training-lane"))
    messages = _messages_stream(fixture.training_messages(spark, sf_dir))
    medallion.training_lane(messages, paths)
    return medallion.training_gold(spark, paths)


def gold_versions(spark, sf_dir):
    """What a reader holds and what a new one finds while a table is replaced: before, after
    a write that failed, and after one that did not."""
    path, events = new_folder(spark, "gold"), _labelled(spark, sf_dir)

    def counted(rows, step, reader):
        return rows.groupBy("churn_label").agg(F.count("*").alias("n")).select(
            F.lit(step).alias("step"), F.lit(reader).alias("reader"), "churn_label", "n"
        )

    versions.replace(events.where("event_id % 3 = 0"), path)
    held = versions.read(spark, path)
    seen = [counted(held, "first", "new")]
    broken = F.when(F.col("event_id") % 7 == 6, F.raise_error(F.lit("cut short"))).otherwise(
        F.col("event_id")
    )
    try:
        versions.replace(events.withColumn("event_id", broken), path)
    except SparkRuntimeException as error:
        if "cut short" not in str(error):
            raise
    seen.append(counted(versions.read(spark, path), "failed", "new"))
    versions.replace(events, path)
    seen += [counted(versions.read(spark, path), "second", "new"), counted(held, "second", "old")]
    return reduce(DataFrame.unionByName, seen)


def medallion_lane_b(spark, sf_dir):
    paths = medallion.LanePaths(new_folder(spark, "scoring-lane"))
    messages = _messages_stream(fixture.scoring_messages(spark, sf_dir))
    medallion.scoring_lane(messages, paths, clock=F.col("timestamp"))
    return _naive(sources.files(spark, paths.table("gold"), schema=GOLD_SCORING))


# Labels and input rules


def churn_label(spark, sf_dir):
    return _labelled(spark, sf_dir).select("event_id", "churn_label")


def label_counts(spark, sf_dir):
    return label.counts(_labelled(spark, sf_dir))


def class_balance(spark, sf_dir):
    return label.balance(_labelled(spark, sf_dir))


def class_weight(spark, sf_dir):
    return label.weight(_labelled(spark, sf_dir)).select(
        "event_id", "churn_label", "class_weight"
    )


def validate_events(spark, sf_dir):
    checked = quality.check(fixture.dirty_events(spark, sf_dir), EVENT_RULES)
    return checked.select(
        "offset",
        (F.size("reject_reasons") == 0).cast("int").alias("is_valid"),
        F.concat_ws(",", "reject_reasons").alias("reasons"),
    )


def reject_reasons(spark, sf_dir):
    return quality.reason_counts(fixture.dirty_events(spark, sf_dir), EVENT_RULES)


def required_fields(spark, sf_dir):
    return quality.presence(fixture.dirty_events(spark, sf_dir))


# Evaluation on fixed scores


def classify_threshold(spark, sf_dir):
    return _classified(spark, sf_dir).select("event_id", "churn_prob", "prediction_custom")


def confusion_crosstab(spark, sf_dir):
    return evaluate.crosstab(_classified(spark, sf_dir))


def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_classified(spark, sf_dir))


def classification_metrics(spark, sf_dir):
    return evaluate.metrics(confusion_matrix(spark, sf_dir))


def confusion_stream(spark, sf_dir):
    """Confusion counts of a stream after each of two drains, restarted in between, and after
    a third without anything new."""
    staged, table, checkpoint = (new_folder(spark, n) for n in ("staged", "counts", "checkpoint"))
    rows = _classified(spark, sf_dir).select("event_id", "churn_label", "prediction_custom")
    keys = rows.drop("event_id").schema
    seen = []
    for drained, half in enumerate((0, 1, None)):
        if half is not None:
            sinks.files(rows.where(F.col("event_id") % 2 == half), staged, mode="append")
        stream = sources.files_stream(spark, staged, rows.schema, maxFilesPerTrigger=2)
        drain(monitor.count_stream(stream, keys.fieldNames(), table, checkpoint))
        cells = cut_lineage(monitor.confusion(monitor.latest(spark, table, keys)))
        seen.append(cells.select(F.lit(drained).alias("drained"), "*"))
    return reduce(DataFrame.unionByName, seen)


def roc_auc_sketched(spark, sf_dir):
    """Areas from sketches stored per batch, against the exact ones and the stated bound."""
    rows = cut_lineage(_charge_scores(spark, sf_dir).select("event_id", "churn_prob", "churn_label"))
    batch = (F.col("event_id") % 5).alias("batch")
    stored = cut_lineage(sketches.of_classes(rows.select("*", batch), by=("batch",)))
    found = sketches.areas(sketches.merged(stored))
    exact = evaluate.areas(evaluate.score_counts(rows))
    near = F.abs(F.col("roc_auc") - exact.select("roc_auc").scalar()) <= sketches.area_error()
    close = F.abs(F.col("pr_auc") - exact.select("pr_auc").scalar()) <= 0.02
    return found.select(
        "n_pos", "n_neg", near.cast("int").alias("is_near"), close.cast("int").alias("is_pr_close")
    )


def _rounded(df: DataFrame, column: str) -> DataFrame:
    # Sums of fractions depend on the order of addition in the last digits.
    return df.select(F.round(column, 10).alias(column))


def roc_auc_exact(spark, sf_dir):
    return _rounded(evaluate.roc_auc(_fixed_scores(spark, sf_dir)), "roc_auc")


def pr_auc_exact(spark, sf_dir):
    return _rounded(evaluate.pr_auc(_fixed_scores(spark, sf_dir)), "pr_auc")


def _charge_scores(spark, sf_dir):
    """A score with thousands of distinct values: the monthly charge itself."""
    return _labelled(spark, sf_dir).withColumn("churn_prob", F.col("monthly_charges"))


def score_curve(spark, sf_dir):
    counted = evaluate.score_counts(_charge_scores(spark, sf_dir))
    return evaluate.curve(counted, ranges=32)


def curve_areas_many_scores(spark, sf_dir):
    counted = evaluate.score_counts(_charge_scores(spark, sf_dir))
    areas = evaluate.areas(counted, ranges=32)
    return areas.select(*[F.round(c, 10).alias(c) for c in areas.columns])


def _mllib(spark, sf_dir, metric, name):
    value = evaluate.mllib_area(
        _fixed_scores(spark, sf_dir), metric, raw="churn_prob", bins=0
    )
    schema = f"{name} double"
    return _rounded(spark.createDataFrame([(value,)], schema), name)


def roc_auc_mllib(spark, sf_dir):
    return _mllib(spark, sf_dir, "areaUnderROC", "roc_auc")


def pr_auc_mllib(spark, sf_dir):
    return _mllib(spark, sf_dir, "areaUnderPR", "pr_auc")


def score_output_record(spark, sf_dir):
    records = score.to_output(
        _classified(spark, sf_dir),
        event=["event_id", *SCORING_EVENT.fieldNames()],
    )
    return records.select("input.*", "prediction")


def score_response_record(spark, sf_dir):
    return score.to_output(_classified(spark, sf_dir), "response")


# Run log and profile


def run_log_table(spark, sf_dir):
    path = new_folder(spark, "runs")
    name = "fixed_scores"
    params = runs.params(
        spark,
        {"model_type": "fixed", "threshold": SPEC.threshold, "maxIter": SPEC.max_iter},
        "run-1",
        name,
    )
    runs.log(params, path)
    runs.log(runs.entries(classification_metrics(spark, sf_dir), "run-1", name, "metric"), path)
    number = F.col("value").try_cast("double")
    return runs.read(spark, path).select(
        "run_id",
        "run_name",
        "kind",
        "key",
        number.alias("number"),
        F.when(number.isNull(), F.col("value")).alias("text"),
    )


def profile_silver(spark, sf_dir):
    events = silver.conform(fixture.training_events(spark, sf_dir), CUSTOMER_EVENT)
    return profiling.profile(events, exact=True)


def head_silver(spark, sf_dir):
    return profiling.head(fixture.training_events(spark, sf_dir), 10, ("timestamp", "event_id"))


# Encoding and models


def _encoded(spark, sf_dir):
    events = _gold(spark, sf_dir)
    counted = encode.category_counts(events, SPEC.categorical)
    return Pipeline(stages=encode.stages(counted, SPEC)).fit(events).transform(events)


def string_index(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "event_id", *[f"{c}_index" for c in SPEC.categorical]
    )


def string_index_table(spark, sf_dir):
    counted = encode.category_counts(_gold(spark, sf_dir), SPEC.categorical)
    return encode.index_table(counted, SPEC.categorical)


def one_hot(spark, sf_dir):
    encoded = _encoded(spark, sf_dir)
    hot = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.array_position(F.col(f"{c}_hot"), 1.0) - 1).cast("int").alias("position"),
            )
            for c in SPEC.categorical
        ]
    )
    dense = encoded.select(
        "event_id",
        *[encode.vector_to_array(f"{c}_ohe").alias(f"{c}_hot") for c in SPEC.categorical],
    )
    return dense.select("event_id", F.inline(hot)).where("position >= 0")


def feature_vector(spark, sf_dir):
    return encode.positions(_encoded(spark, sf_dir), "features", keep=("event_id",))


def _place():
    """An event's place among 100 as SQL can give it, in the place of a hash."""
    return F.pmod(F.col("event_id") * 7919, F.lit(100))


def split_counts(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    part = F.when(model.in_training(labelled, _place(), SPEC.train_percent), "train")
    return (
        labelled
        .groupBy(part.otherwise("test").alias("part"), "churn_label")
        .agg(F.count("*").alias("n"))
    )


def train_metrics(spark, sf_dir):
    """Parts, width, balance and what must hold of a logged run, as one row."""
    log = new_folder(spark, "runs")
    run = training.run(_stored_gold(spark, sf_dir), new_folder(spark, "models"), log, key=_place())
    logged = {r["key"]: float(r["value"]) for r in runs.read(spark, log).where("kind = 'metric'").collect()}
    fitted = run.fitted
    test = training.score_test(fitted)
    half = test.agg(
        F.expr("count_if(churn_label = 1 and churn_prob >= 0.5)"), F.expr("count_if(churn_label = 1)")
    ).first()
    # At the optimum weighted residuals cancel out.
    weighted = score.batch(
        label.weight(fitted.train, fitted.balance_ratio), fitted.model, trust_buckets=True
    )
    pull = weighted.agg(
        F.sum(F.col("class_weight") * (F.col("churn_prob") - F.col("churn_label")))
        / F.sum("class_weight")
    ).first()[0]
    row = (
        fitted.n_train,
        fitted.n_test,
        fitted.model.stages[-1].numFeatures,
        fitted.balance_ratio,
        int(sum(logged[c] for c in ("TP", "TN", "FP", "FN"))),
        int(logged["recall_class_1"] >= half[0] / max(half[1], 1)),
        int(abs(pull) < 0.01),
    )
    return spark.createDataFrame(
        [row],
        "n_train bigint, n_test bigint, n_features int, balance_ratio double, "
        "n_confusion bigint, recall_rises int, is_balanced int",
    )


def train_hashed(spark, sf_dir):
    """Training with categories hashed into 64 places: width, rows, and what must hold."""
    spec = ModelSpec(hash_width=64)
    fitted = training.fit(_stored_gold(spark, sf_dir), key=_place(), spec=spec)
    measured = training.report(training.score_test(fitted, spec), spec).first()
    row = (
        fitted.model.stages[-1].numFeatures,
        fitted.n_train,
        fitted.n_test,
        int(measured["roc_auc"] > 0.9),
    )
    return spark.createDataFrame(
        [row], "n_features int, n_train bigint, n_test bigint, is_learned int"
    )


def train_row_counts(spark, sf_dir):
    """Where the rows of the damaged events go in training."""
    events = cut_lineage(gold.features(fixture.dirty_events(spark, sf_dir)))
    place = F.pmod(F.col("offset") * 7919, F.lit(100))
    fitted = training.fit(events, key=place)
    counts = {
        "n_rows": fitted.n_rows,
        "n_train": fitted.n_train,
        "n_test": fitted.n_test,
        "n_rejected": fitted.n_rejected,
        **{f"rejected_{c}": fitted.rejected.get(c, 0) for c in SPEC.numeric},
    }
    return spark.createDataFrame(list(counts.items()), "count string, n bigint")


def medallion_train(spark, sf_dir):
    """Messages through the training lane to gold and to a logged model."""
    paths = medallion.LanePaths(new_folder(spark, "training-lane"))
    medallion.training_lane(_messages_stream(fixture.training_messages(spark, sf_dir)), paths)
    table = medallion.training_gold(spark, paths)
    log = new_folder(spark, "runs")
    run = training.run(table, new_folder(spark, "models"), log)
    logged = {r["key"]: r["value"] for r in runs.read(spark, log).collect()}
    share = run.fitted.n_train / run.fitted.n_rows
    row = (
        int(logged["n_rows"]),
        int(logged["n_train"]) + int(logged["n_test"]),
        int(logged["n_rejected"]),
        int(abs(share - SPEC.train_percent / 100) < 0.05),
        int(float(logged["roc_auc"]) > 0.9),
    )
    return spark.createDataFrame(
        [row], "n_rows bigint, n_used bigint, n_rejected bigint, is_split int, is_learned int"
    )


def score_rows(spark, sf_dir, **options):
    fitted = training.fit(_stored_gold(spark, sf_dir))
    events = fixture.customer_events(spark, sf_dir)
    return fitted, score.batch(events, fitted.model, SPEC.threshold, **options)


def _facts(scored):
    """What must hold of scores: counts of rows on which it does not."""
    p = F.col("churn_prob")
    return [
        F.count("*").alias("n_rows"),
        F.count_if(p.isNull() | F.isnan(p) | ~p.between(0, 1)).alias("n_out_of_range"),
        F.count_if(
            ~F.col("prediction_custom").eqNullSafe((p >= SPEC.threshold).cast("int"))
        ).alias("n_class_wrong"),
    ]


def score_batch(spark, sf_dir):
    """Scores against the coefficients times the features, added up in long form."""
    fitted, scored = score_rows(spark, sf_dir)
    classifier = fitted.model.stages[-1]
    coefficients = spark.createDataFrame(
        [(i, float(c)) for i, c in enumerate(classifier.coefficients)],
        "position int, coefficient double",
    )
    encoded = gold.features(fixture.customer_events(spark, sf_dir))
    for stage in fitted.model.stages[:-1]:
        encoded = stage.transform(encoded)
    margins = (
        encode.positions(encoded, "features", keep=("event_id",))
        .join(F.broadcast(coefficients), "position")
        .groupBy("event_id")
        .agg(F.sum(F.col("value") * F.col("coefficient")).alias("margin"))
    )
    again = 1 / (1 + F.exp(-(F.col("margin") + float(classifier.intercept))))
    return scored.join(margins, "event_id", "left").agg(
        *_facts(scored),
        F.count_if(~F.coalesce(F.abs(F.col("churn_prob") - again) < 1e-9, F.lit(False))).alias(
            "n_differs"
        ),
    )


def score_probability(spark, sf_dir):
    """The model's own probability vector and the number taken from it."""
    _, scored = score_rows(spark, sf_dir, vectors=True)
    vector = encode.vector_to_array("probability")
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.get(vector, F.lit(1)) == F.col("churn_prob")).alias("n_second"),
        F.count_if(F.abs(F.get(vector, F.lit(0)) + F.get(vector, F.lit(1)) - 1) < 1e-12).alias(
            "n_whole"
        ),
    )


def score_saved_model(spark, sf_dir):
    """Scores before saving and after loading, compared on every event."""
    table = _stored_gold(spark, sf_dir)
    fitted = training.fit(table)
    path = model.save_version(fitted.model, new_folder(spark, "models"), "v1")
    events = table.select("event_id", *SPEC.inputs)
    before = score.batch(events, fitted.model)
    after = score.batch(
        before.withColumnRenamed("churn_prob", "before").drop("prediction_custom"),
        model.load(path),
    )
    return after.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("churn_prob") != F.col("before")).alias("n_different"),
    )


def _feature_messages(spark, sf_dir, events, half=None):
    texts = gold.to_message(gold.features(_dirty_stamped(spark, sf_dir, events, half)))
    return texts.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("churn_features").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _numbered_feature_messages(spark, sf_dir, events):
    """Feature messages with the event's number as their offset."""
    messages = fixture.dirty_messages(spark, sf_dir, events)
    texts = bronze.decode(messages, keep=("offset", "timestamp"))
    parsed = silver.parse(texts, SCORING_EVENT, keep=("offset", "timestamp"))
    featured = gold.features(bronze.stamp(parsed, F.col("timestamp")))
    value = F.to_json(F.struct(*GOLD_SCORING.fieldNames())).cast("binary")
    return featured.select(
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.lit("churn_features").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def score_stream_rows(spark, sf_dir, halves=(None,), runs_each=1):
    """Feature messages scored by a stream; the model, the messages as they were staged, and
    the scored and rejected rows read back.

    The messages may come in halves, with the stream run after each, and again without
    anything new; its checkpoints are its read position. They are made from the stored
    events, which are thus joined once.
    """
    events = _stored_gold(spark, sf_dir)
    fitted = training.fit(events)
    staged = new_folder(spark, "staged")
    scores, rejects = new_folder(spark, "scores"), new_folder(spark, "rejects")
    positions = {path: new_folder(spark, "checkpoint") for path in (scores, rejects)}

    def to(path):
        return lambda df: sinks.files_stream(df, path, positions[path], trigger=DRAIN)

    for half in halves:
        sinks.files(_feature_messages(spark, sf_dir, events, half), staged, mode="append")
        for _ in range(runs_each):
            stream = sources.files_stream(spark, staged, KAFKA)
            for query in scorer.stream(
                stream, fitted.model, to(scores), to(rejects), SPEC.threshold
            ):
                drain(query)
    accepted = spark.read.parquet(scores).select(
        "input.*", "prediction", F.lit("").alias("reasons")
    )
    refused = spark.read.parquet(rejects).select(
        *GOLD_SCORING.fieldNames(),
        F.lit(None).cast("double").alias("prediction"),
        F.concat_ws(",", "reject_reasons").alias("reasons"),
    )
    messages = sources.files(spark, staged, schema=KAFKA)
    return fitted, messages, _naive(accepted.unionByName(refused))


def score_stream_redelivered(spark, sf_dir):
    """What was scored or refused when half of the messages are delivered twice or more, in
    one run and across a restart, counted by reason."""
    events = _stored_gold(spark, sf_dir)
    fitted = training.fit(events)
    names = ("staged", "features", "scores", "rejects", "checkpoint")
    staged, features, scores, rejects, checkpoint = (new_folder(spark, n) for n in names)
    messages = cut_lineage(_numbered_feature_messages(spark, sf_dir, events))
    even, fourth = F.col("offset") % 2 == 0, F.col("offset") % 4
    for deliveries in ([even, fourth == 0], [~even, fourth == 0, fourth == 1, fourth == 1]):
        for delivered in deliveries:
            sinks.files(messages.where(delivered), staged, mode="append")
        drain(
            scorer.stream_once(
                sources.files_stream(spark, staged, KAFKA),
                fitted.model,
                features,
                checkpoint,
                batches.to_files(scores),
                batches.to_files(rejects),
                SPEC.threshold,
                redelivery="1 hour",
            )
        )
    accepted = spark.read.parquet(scores).select("prediction", F.lit("").alias("reasons"))
    refused = spark.read.parquet(rejects).select(
        F.lit(None).cast("double").alias("prediction"),
        F.concat_ws(",", "reject_reasons").alias("reasons"),
    )
    return _reason_counts(accepted.unionByName(refused))


def score_stream(spark, sf_dir):
    """The stream's scores against those of a batch over the same messages."""
    fitted, messages, rows = score_stream_rows(spark, sf_dir)
    features = scorer.read_features(messages)
    batch = scorer.scored(features, fitted.model, SPEC.threshold).select("input.*", "prediction")
    streamed = rows.where("reasons = ''").drop("reasons")
    names = streamed.columns
    balance = (
        streamed.select(*names, F.lit(1).alias("_n"))
        .unionByName(_naive(batch).select(*names, F.lit(-1).alias("_n")))
        .groupBy(*names)
        .agg(F.sum("_n").alias("_n"))
        .agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0)).alias("n_differs"))
    )
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.expr("count_if(reasons = '')").alias("n_scored"),
        F.expr("count_if(reasons = '' and prediction not in (0.0, 1.0))").alias("n_out_of_range"),
        F.expr("count_if(reasons = '' and prediction is null)").alias("n_unscored"),
    ).select("*", balance.scalar().alias("n_differs"))


def _halved(messages, half):
    """All messages, or those whose event number is even or odd."""
    return messages if half is None else messages.where(F.col("offset") % 2 == half)


def _dirty_stamped(spark, sf_dir, events=None, half=None):
    messages = _halved(fixture.dirty_messages(spark, sf_dir, events), half)
    texts = bronze.decode(messages, keep=("timestamp",))
    parsed = silver.parse(texts, SCORING_EVENT, keep=("timestamp",))
    return silver.conform(bronze.stamp(parsed, F.col("timestamp")), STAMPED_EVENT)


def _reason_counts(rows):
    return rows.groupBy("reasons").agg(
        F.count("*").alias("n_rows"), F.count("prediction").alias("n_scored")
    )


def score_stream_counts(spark, sf_dir):
    """How many messages the streaming scorer accepted, and refused for what."""
    return _reason_counts(score_stream_rows(spark, sf_dir)[-1])


def score_stream_restart(spark, sf_dir):
    """The same counts when messages come in two halves and each run is repeated."""
    return _reason_counts(score_stream_rows(spark, sf_dir, halves=(0, 1), runs_each=2)[-1])


# Restarts and waiting


def stream_restart(spark, sf_dir):
    """The scoring lane run on one half of the messages, on both, and once more."""
    paths = medallion.LanePaths(new_folder(spark, "restarted-lane"))
    staged = new_folder(spark, "staged")
    for half in (0, 1, None):
        if half is not None:
            messages = _halved(fixture.scoring_messages(spark, sf_dir), half)
            sinks.files(messages, staged, mode="append")
        stream = sources.files_stream(spark, staged, KAFKA)
        medallion.scoring_lane(stream, paths, clock=F.col("timestamp"))
    return _naive(sources.files(spark, paths.table("gold"), schema=GOLD_SCORING))


def stream_await(spark, sf_dir):
    """Both sinks of a fan-out, waited for together."""
    stream = gold.features(
        sources.files_stream(spark, _staged(_stamped(spark, sf_dir)), STAMPED_EVENT)
    )
    folders = [new_folder(spark, "table"), new_folder(spark, "messages")]

    def to(df, folder):
        return sinks.files_stream(df, folder, new_folder(spark, "checkpoint"), trigger=DRAIN)

    queries = sinks.fan_out(
        stream,
        [lambda df: to(df, folders[0]), lambda df: to(gold.to_message(df), folders[1])],
    )
    await_all(queries, poll=1)
    counts = [
        spark.read.parquet(folder).agg(
            F.lit(sink).alias("sink"),
            F.count("*").alias("n_rows"),
            F.lit(sum(q.isActive for q in queries)).alias("n_running"),
        )
        for sink, folder in zip(("table", "message"), folders, strict=True)
    ]
    return counts[0].unionByName(counts[1])


QUERIES = {
    "feat_payment_risky": _column("is_payment_risky"),
    "feat_high_support": _column("is_high_support"),
    "feat_high_support_alt": _column("is_high_support_customer", ALT_SUPPORT_RULES),
    "feat_tenure_bucket": _column("tenure_bucket"),
    "feat_charge_bucket": _column("charge_bucket"),
    "feat_risk_score": _column("engagement_risk_score"),
} | {
    query.__name__: query
    for query in (
        gold_label_counts,
        src_json_stream,
        src_json_batch_inferred,
        src_json_fields,
        src_json_drift,
        src_json_merged_schema,
        sink_json_stream,
        sink_json_batch,
        rows_source,
        bronze_raw,
        bronze_ingest_stamp,
        silver_parsed,
        silver_conformed,
        silver_coerced,
        silver_defects,
        defect_counts,
        gold_batch,
        gold_overwrites_buckets,
        gold_message,
        gold_stream,
        gold_stream_fanout,
        gold_fanout_once,
        gold_compacted,
        medallion_lane_a,
        medallion_lane_b,
        churn_label,
        label_counts,
        class_balance,
        class_weight,
        validate_events,
        reject_reasons,
        required_fields,
        classify_threshold,
        confusion_crosstab,
        confusion_matrix,
        classification_metrics,
        roc_auc_exact,
        pr_auc_exact,
        score_curve,
        curve_areas_many_scores,
        roc_auc_mllib,
        pr_auc_mllib,
        score_output_record,
        score_response_record,
        run_log_table,
        profile_silver,
        head_silver,
        string_index,
        string_index_table,
        one_hot,
        feature_vector,
        split_counts,
        train_metrics,
        train_hashed,
        gold_versions,
        confusion_stream,
        roc_auc_sketched,
        score_batch,
        score_saved_model,
        score_stream,
        score_stream_counts,
        train_row_counts,
        medallion_train,
        score_probability,
        score_stream_restart,
        score_stream_redelivered,
        stream_restart,
        stream_await,
    )
}
