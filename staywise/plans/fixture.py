"""Customer events derived from the bundled test tables.

The tables hold events, customers, nations and regions; joined, they carry every
field of a customer event. The same definition is written once more as SQL for the
comparison engine in ``oracle``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staywise.operators import bronze, silver
from staywise.schemas import CUSTOMER_EVENT, SCORING_EVENT

TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, event_time`` and the customer event fields but ``timestamp``.

    Events are joined to one stored table at a time, so that each build side has its
    file size for an estimate: Spark broadcasts a table below its size threshold only,
    and beyond that sort-merges with adaptive splitting of keys that hold too many
    events.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    segment = F.col("c_mktsegment")
    cents = F.round(F.col("value") * 100).cast("bigint") % 13001
    return (
        _table(spark, sf_dir, "events")
        .join(
            _table(spark, sf_dir, "customer"),
            F.col("user_id") == F.col("c_custkey"),
        )
        .join(
            _table(spark, sf_dir, "nation"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        .join(
            _table(spark, sf_dir, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .select(
            "event_id",
            F.col("ts").alias("event_time"),
            F.col("user_id").cast("int").alias("customer_id"),
            (18 + F.col("user_id") * 7 % 53).cast("int").alias("age"),
            F.when(F.col("user_id") % 2 == 0, "Male").otherwise("Female").alias("gender"),
            F.col("r_name").alias("location"),
            F.when(segment.isin("AUTOMOBILE", "BUILDING"), "Basic")
            .when(segment.isin("FURNITURE", "HOUSEHOLD"), "Standard")
            .otherwise("Premium")
            .alias("subscription_type"),
            (20.0 + cents.cast("double") / 100.0).alias("monthly_charges"),
            (1 + F.col("event_id") % 72).cast("int").alias("tenure_months"),
            (k % 11).cast("int").alias("support_tickets"),
            ((F.col("event_id") + k) % 6).cast("int").alias("late_payments"),
        )
    )


def _timestamp_text():
    return F.date_format("event_time", TIMESTAMP_TEXT)


def training_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` and the ten fields of a training-lane event."""
    events = customer_events(spark, sf_dir).withColumn("timestamp", _timestamp_text())
    return events.select("event_id", *CUSTOMER_EVENT.fieldNames())


def scoring_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, event_time`` and the nine fields of a scoring event. The buckets
    are stale on purpose, so that replacing them shows."""
    stale = {"tenure_bucket": F.lit("new"), "charge_bucket": F.lit("high")}
    return (
        customer_events(spark, sf_dir)
        .withColumns(stale)
        .select("event_id", "event_time", *SCORING_EVENT.fieldNames())
    )


def _as_messages(df: DataFrame, topic: str, text) -> DataFrame:
    """Kafka-shaped rows; the event id serves as the offset."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def training_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the JSON message a producer would have sent."""
    events = customer_events(spark, sf_dir)
    fields = F.struct(
        *[c for c in CUSTOMER_EVENT.fieldNames() if c != "timestamp"],
        _timestamp_text().alias("timestamp"),
    )
    return _as_messages(events, "churn_events", F.to_json(fields))


def scoring_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scoring_events(spark, sf_dir)
    fields = F.struct(*SCORING_EVENT.fieldNames())
    return _as_messages(events, "churn_input", F.to_json(fields))


def dirty_messages(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None
) -> DataFrame:
    """All events as messages, seven in fifty damaged, each in its own way.

    ``events`` are the customer events, if they are stored already.
    """
    if events is None:
        events = customer_events(spark, sf_dir)
    kind = F.col("event_id") % 50
    fields = F.struct(
        "customer_id",
        "age",
        F.when(kind == 1, "Other").otherwise(F.col("gender")).alias("gender"),
        "location",
        F.when(kind == 3, "Gold")
        .otherwise(F.col("subscription_type"))
        .alias("subscription_type"),
        "monthly_charges",
        F.when(kind != 2, F.col("tenure_months")).alias("tenure_months"),
        "support_tickets",
        "late_payments",
        _timestamp_text().alias("timestamp"),
    )
    text = F.to_json(fields)
    quoted = F.regexp_replace(
        text, r'"support_tickets":(\d+)', '"support_tickets":"$1"'
    )
    endless = F.regexp_replace(
        text,
        r'"monthly_charges":[^,}]+',
        F.when(kind == 5, '"monthly_charges":"NaN"').otherwise('"monthly_charges":"Infinity"'),
    )
    damaged = (
        F.when(kind == 0, "not json")
        .when(kind == 4, quoted)
        .when(kind.isin(5, 6), endless)
        .otherwise(text)
    )
    return _as_messages(events, "churn_events", damaged)


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as messages, fifteen in fifty broken, each in its own way as JSON."""
    events = customer_events(spark, sf_dir)
    kind = F.col("event_id") % 50
    text = F.to_json(
        F.struct(
            *[c for c in CUSTOMER_EVENT.fieldNames() if c != "timestamp"],
            _timestamp_text().alias("timestamp"),
        )
    )

    def put(text, field, value):
        return F.regexp_replace(text, f'"{field}":("[^"]*"|[^,}}]*)', f'"{field}":{value}')

    broken = (
        F.when(kind == 0, "not json")
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, "  ")
        .when(kind == 3, F.concat(F.lit("["), text, F.lit("]")))
        .when(kind == 4, F.expr("left(t, length(t) - 1)"))
        .when(kind == 5, put(text, "tenure_months", "null"))
        .when(kind == 6, put(text, "support_tickets", '"$1"'))
        .when(kind == 7, put(text, "customer_id", "300000000$1"))
        .when(kind == 8, put(text, "late_payments", "$1.5"))
        .when(kind == 9, put(text, "monthly_charges", '"NaN"'))
        .when(kind == 10, put(text, "monthly_charges", "1e999"))
        .when(kind == 11, put(text, "gender", "5"))
        .when(kind == 12, put(text, "location", '{"name":$1}'))
        .when(kind == 13, F.concat(F.lit('{"tier":1,"Age":2,'), F.expr("substr(t, 2)")))
        .when(kind == 14, put(F.regexp_replace(text, '"age":[0-9]+,', ""), "tenure_months", "null"))
        .otherwise(text)
    )
    return _as_messages(events.withColumn("t", text), "churn_events", broken)


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged messages parsed, ``offset`` kept as the row's identity."""
    texts = bronze.decode(dirty_messages(spark, sf_dir), keep=("offset",))
    return silver.parse(texts, CUSTOMER_EVENT, keep=("offset",))
