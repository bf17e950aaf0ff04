"""Declared schemas. Nothing in the library relies on schema inference."""

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Field names, types and their order are the data contract.
KAFKA = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
    ("timestampType", IntegerType()),
)

RAW = _struct(("raw_json", StringType()))

CUSTOMER_EVENT = _struct(
    ("customer_id", IntegerType()),
    ("age", IntegerType()),
    ("gender", StringType()),
    ("location", StringType()),
    ("subscription_type", StringType()),
    ("monthly_charges", DoubleType()),
    ("tenure_months", IntegerType()),
    ("support_tickets", IntegerType()),
    ("late_payments", IntegerType()),
    ("timestamp", StringType()),
)

SCORING_EVENT = _struct(
    ("gender", StringType()),
    ("location", StringType()),
    ("subscription_type", StringType()),
    ("tenure_months", IntegerType()),
    ("monthly_charges", DoubleType()),
    ("support_tickets", IntegerType()),
    ("late_payments", IntegerType()),
    ("tenure_bucket", StringType()),
    ("charge_bucket", StringType()),
)

STAMPED_EVENT = StructType(
    SCORING_EVENT.fields + [StructField("ingestion_time", TimestampType(), True)]
)

_FLAGS = _struct(
    ("is_payment_risky", IntegerType()),
    ("is_high_support", IntegerType()),
)

_RISK_SCORE = _struct(("engagement_risk_score", IntegerType()))

# Scoring lane: both buckets are already columns and are replaced in place.
GOLD_SCORING = StructType(STAMPED_EVENT.fields + _FLAGS.fields + _RISK_SCORE.fields)

# Training lane: the buckets are new columns.
GOLD_TRAINING = StructType(
    CUSTOMER_EVENT.fields
    + _FLAGS.fields
    + _struct(("tenure_bucket", StringType()), ("charge_bucket", StringType())).fields
    + _RISK_SCORE.fields
)

RUN_LOG = _struct(
    ("run_id", StringType()),
    ("run_name", StringType()),
    ("kind", StringType()),
    ("key", StringType()),
    ("value", StringType()),
)
