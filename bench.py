"""Time the headline jobs and print one JSON line.

Inputs are prepared before the clock starts: the gold table, the messages and a fitted
model lie ready, as they would in production. Each job runs once to warm up and twice on
the clock; the better time counts.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from staywise import sinks, sources  # noqa: E402
from staywise.config import EVENT_RULES, ModelSpec  # noqa: E402
from staywise.operators import (  # noqa: E402
    bronze,
    encode,
    evaluate,
    gold,
    label,
    profiling,
    quality,
    score,
    silver,
)
from staywise.plans import fixture, registry, training  # noqa: E402
from staywise.schemas import KAFKA  # noqa: E402
from staywise.sinks.file_tables import DRAIN  # noqa: E402
from staywise.streaming import medallion, scorer  # noqa: E402
from staywise.streaming.control import drain  # noqa: E402
from staywise.workspace import new_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("staywise-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df):
    """Produce every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def jobs(spark):
    spec = ModelSpec()

    def staged(df):
        path = new_folder(spark, "bench")
        sinks.files(df, path)
        return path

    gold_table = spark.read.parquet(staged(gold.features(fixture.customer_events(spark, SF_DIR))))
    raw = staged(fixture.training_messages(spark, SF_DIR))
    events = staged(fixture.scoring_messages(spark, SF_DIR))
    texts = bronze.decode(spark.read.parquet(raw), keep=("offset",))
    features = staged(
        gold.to_message(gold.features(registry._stamped(spark, SF_DIR))).select(
            F.lit(None).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit("churn_features").alias("topic"),
            F.lit(0).alias("partition"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
    )
    fitted = training.fit(gold_table)
    labelled = label.churn(gold_table)
    fixed = evaluate.classify(
        labelled.withColumn("churn_prob", F.col("monthly_charges") / 150.0)
    )

    def stream(path):
        return sources.files_stream(spark, path, KAFKA)

    def paths():
        return medallion.LanePaths(new_folder(spark, "lane"))

    def training_lane():
        where = paths()
        medallion.training_lane(stream(raw), where)
        medallion.training_gold(spark, where)

    def score_stream():
        def to(df):
            return sinks.files_stream(
                df, new_folder(spark, "out"), new_folder(spark, "cp"), trigger=DRAIN
            )

        for query in scorer.stream(stream(features), fitted.model, to, to):
            drain(query)

    return {
        "gold_label_counts": lambda: consume(registry.gold_label_counts(spark, SF_DIR)),
        "gold_from_tables": lambda: consume(registry.gold_batch(spark, SF_DIR)),
        "silver_parse": lambda: consume(silver.parse(texts, keep=("offset",))),
        "validate": lambda: consume(quality.check(silver.parse(texts), EVENT_RULES)),
        "gold_batch": lambda: consume(gold.features(gold_table)),
        "label_counts": lambda: consume(label.counts(labelled)),
        "class_weight": lambda: consume(label.weight(labelled)),
        "string_index": lambda: consume(
            encode.index_table(
                encode.category_counts(gold_table, spec.categorical), spec.categorical
            )
        ),
        "confusion_metrics": lambda: consume(evaluate.metrics(evaluate.confusion(fixed))),
        "curve_areas": lambda: consume(evaluate.areas(evaluate.score_counts(fixed))),
        "profile": lambda: consume(profiling.profile(gold_table)),
        "pipeline_fit": lambda: training.fit(gold_table),
        "evaluate_model": lambda: consume(training.report(training.score_test(fitted))),
        "score_batch": lambda: consume(score.batch(gold_table, fitted.model)),
        "medallion_training_lane": training_lane,
        "medallion_scoring_lane": lambda: medallion.scoring_lane(stream(events), paths()),
        "score_stream": score_stream,
    }


def main():
    spark = session()
    times, cold = {}, {}
    for name, job in jobs(spark).items():
        start = time.perf_counter()
        job()
        cold[name] = round(time.perf_counter() - start, 3)
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
