"""What JSON said of each field, against a reading of the text by Python."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from staywise.operators import bronze, defects, silver
from staywise.plans import fixture
from staywise.schemas import CUSTOMER_EVENT

SCHEMA = StructType().add("a", IntegerType()).add("d", DoubleType()).add("s", StringType()).add("a b", LongType())

TEXTS = [
    '{"a":1,"d":1.5,"s":"x","a b":2}', '{"a":1.0,"d":1,"s":5,"a b":9223372036854775807}',
    '{"a":3000000000,"d":1e400,"s":null,"a b":9223372036854775808}', '{"a":-2147483648,"d":-0.0}',
    '{"a":-2147483649,"d":99999999999999999999,"s":"","z":1,"b":[2]}', '{"a":"1","d":"NaN","s":true}',
    '{"a":{},"d":[],"s":{}}', '{"A":1,"s":"\\u00e9\\n"}', "[1]", "5", '"text"', "null", "no", "", " \t ", None,
    '{"a":1e0,"d":1e-3,"s":"é"}', '{"a":1', '{"a":false,"a b":null}', "{}", '{"a":5.5,"a b":9223372036854775808.0}',
    '{"d":123456789012345678901234567890123456789012345.5}', "x" * 100_000, '{"s":"' + "y" * 100_000 + '"}',
]


class Number(str):
    """A JSON number as it was written."""


def slow_state(value, kind):
    if value is None:
        return "null"
    if isinstance(kind, StringType):
        return None if type(value) is str else "wrong_type"
    if not isinstance(value, Number):
        return "wrong_type"
    if isinstance(kind, DoubleType):
        return "overflow" if abs(float(value)) == float("inf") else None
    if set(value) & set(".eE"):
        # Beyond 64 bits a point is not told from none.
        return "wrong_type" if abs(float(value)) < 2**63 else "overflow"
    bits = 31 if isinstance(kind, IntegerType) else 63
    return None if -(2**bits) <= int(value) < 2**bits else "overflow"


def slow_read(text, schema):
    if not (text or "").strip():
        return [("message", "empty")], []
    try:
        found = json.loads(text, parse_int=Number, parse_float=Number)
    except ValueError:
        return [("message", "malformed")], []
    if not isinstance(found, dict):
        return [("message", "no_object")], []
    states = [
        (f.name, slow_state(found[f.name], f.dataType) if f.name in found else "absent") for f in schema
    ]
    return [(n, s) for n, s in states if s], sorted(set(found) - set(schema.fieldNames()))


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "n int, raw_json string")
    return defects.read(df, SCHEMA, keep=("n",)).orderBy("n").collect()


def test_defects(read):
    for row, text in zip(read, TEXTS, strict=True):
        found = [(d.field, d.state) for d in row.defects], row.unknown
        assert found == slow_read(text, SCHEMA), text


def test_fields_are_null_only_with_a_defect(read):
    for row, text in zip(read, TEXTS, strict=True):
        wrong = {d.field for d in row.defects}
        for f in SCHEMA:
            assert (row[f.name] is None) == (f.name in wrong or "message" in wrong)
            if row[f.name] is not None:
                said = json.loads(text)[f.name]
                assert row[f.name] == (said if isinstance(f.dataType, StringType) else pytest.approx(said))


def test_one_parse_per_row(spark, sf_dir):
    """Also under filters on fields and defects."""
    texts = bronze.decode(fixture.broken_messages(spark, sf_dir))
    read = defects.read(texts)
    for df in (read, defects.clean(read).where("age > 30 and gender = 'Male'"), defects.counts(read)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("parseJson") == 1


def test_each_field_is_looked_up_once(spark, sf_dir):
    texts = bronze.decode(fixture.broken_messages(spark, sf_dir), keep=("offset",))
    read = defects.read(texts)
    for df in (read, defects.clean(read).where("age > 30"), defects.faulty(read), defects.counts(read)):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        for field in CUSTOMER_EVENT.fieldNames():
            assert text.count(f"$['{field}']") == 1
        # One of each field, and one of the message.
        assert text.count("schema_of_variant") + text.count("schemaOfVariant") == len(CUSTOMER_EVENT) + 1


def test_clean_rows_are_those_of_the_parser(spark, sf_dir):
    texts = bronze.decode(fixture.broken_messages(spark, sf_dir), keep=("offset",))
    read = defects.read(texts, keep=("offset",))
    clean, faulty = defects.clean(read), defects.faulty(read)
    assert clean.count() + faulty.count() == texts.count() == 1000
    parsed = silver.parse(texts, CUSTOMER_EVENT, keep=("offset",)).join(
        clean.select("offset"), "offset", "left_semi"
    )
    assert clean.columns == parsed.columns
    assert clean.exceptAll(parsed).count() == parsed.exceptAll(clean).count() == 0
    kinds = {r.kind for r in faulty.select((F.col("offset") % 50).alias("kind")).collect()}
    assert kinds == {*range(13), 14}
    # Absent and null fields may be let through.
    left = defects.faulty(read, (defects.ABSENT, defects.NULL))
    assert {r.kind for r in left.select((F.col("offset") % 50).alias("kind")).collect()} == {
        *range(5), *range(6, 13)
    }


def test_nothing_to_read(spark):
    empty = spark.createDataFrame([], "raw_json string")
    assert defects.read(empty).collect() == [] == defects.counts(defects.read(empty)).collect()


def test_on_a_stream(spark, sf_dir, tmp_path):
    from staywise import sinks, sources
    from staywise.schemas import KAFKA
    from staywise.sinks.file_tables import DRAIN
    from staywise.streaming.control import drain

    fixture.broken_messages(spark, sf_dir).write.parquet(str(tmp_path / "topic"))
    stream = sources.files_stream(spark, str(tmp_path / "topic"), KAFKA)
    faulty = defects.faulty(defects.read(bronze.decode(stream, keep=("offset",)), keep=("offset",)))
    drain(sinks.files_stream(faulty, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=DRAIN))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 280
