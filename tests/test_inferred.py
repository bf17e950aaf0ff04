"""Schemas found file by file: merged in any order, new files alone read, drift."""

import itertools

import pytest
from pyspark.sql import functions as F

from staywise import sources
from staywise.sources import inferred

FILES = {
    "a": ['{"x":1,"y":"t","z":null}', '{"x":2.5,"n":{"k":1}}', "broken", "[1]", ""],
    "b": ['{"x":12345678901234567890,"y":5,"u":true}', '{"n":{"k":2}}'],
    "c": ['{"x":1e3,"z":null,"u":null}', '{"w":[1,2]}'],
    "d": ['{"z":1.25,"w":["a"]}', '{"z":100}', "null"],
    "e": ["no", "json"],
}
TEXT = "file string, modified timestamp, value string"


def lines(spark, names):
    rows = [(f, None, t) for f in names for t in FILES[f]]
    return spark.createDataFrame(rows, TEXT)


@pytest.fixture(scope="module")
def per_file(spark):
    """What is stored of each file, found alone."""
    return {f: inferred.found(lines(spark, [f])).collect() for f in FILES}


def test_counts_of_a_file(per_file):
    rows = {r.field: (r.n, r.n_null) for r in per_file["a"]}
    assert rows == {None: (5, 3), "x": (2, 0), "y": (1, 0), "z": (1, 1), "n": (1, 0)}
    assert {r.field: r.type for r in per_file["e"]} == {None: "VOID"}


@pytest.mark.parametrize("names", [c for n in (1, 2, 3, 5) for c in itertools.combinations(FILES, n)])
def test_merged_types_are_those_of_all_lines_at_once(spark, per_file, names):
    stored = spark.createDataFrame([r for f in names for r in per_file[f]], inferred.FOUND)
    merged = {r.field: r.type for r in inferred.fields(stored).collect()}
    at_once = inferred.found(lines(spark, names).withColumn("file", F.lit("all")))
    # The aggregate merges the insides of arrays and objects, the stored types only equal ones.
    expected = {
        r.field: r.type
        for r in at_once.where("field is not null").select("field", inferred.spark_type(F.col("type")).alias("type")).collect()
    }
    if {"c", "d"} <= set(names):
        assert (merged.pop("w"), expected.pop("w")) == ("string", "array<string>")
    assert merged == expected


def test_decimals_beyond_38_digits_are_doubles(spark):
    rows = [("f", None, "x", t, 1, 0) for t in ("DECIMAL(38,0)", "DECIMAL(5,3)")]
    found = inferred.fields(spark.createDataFrame(rows, inferred.FOUND)).first()
    assert found.type == "double"
    types = lambda *t: spark.range(1).select(inferred._merged(F.array(*map(F.lit, t)))).first()[0]
    assert types("BIGINT", "DECIMAL(3,1)") == "DECIMAL(21,1)"
    assert types("DECIMAL(3,1)", "DECIMAL(4,3)") == "DECIMAL(5,3)"
    assert types("DECIMAL(30,0)", "DECIMAL(20,19)") == "DOUBLE"
    assert types("VOID") == "VOID" and types("VOID", "STRING") == "STRING"
    assert types("STRING", "BIGINT") == "VARIANT" == types("BOOLEAN", "DOUBLE")


def test_only_new_files_are_read(spark, tmp_path):
    path, store = str(tmp_path / "json"), str(tmp_path / "fields")
    read = []
    for names in (["a", "b"], ["c"], [], ["d", "e"]):
        for f in names:
            lines(spark, [f]).select("value").coalesce(1).write.mode("append").text(path)
        query = inferred.update(spark, path, store, maxFilesPerTrigger=1)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read == [sum(len(FILES[f]) for f in names) for names in ("ab", "c", "", "de")]
    stored = inferred.stored(spark, store, keep=("batch_id",))
    assert stored.select("file").distinct().count() == 5
    assert stored.where("modified is null").count() == 0
    kinds = {r.field: r.type for r in inferred.fields(stored).collect()}
    assert kinds["x"] == "double" and kinds["y"] == "string" and kinds["n"] == "struct<k: bigint>"
    rows = sources.files(spark, path, "json", inferred.schema(stored))
    assert rows.columns == sorted(kinds) and rows.where("n.k = 2").count() == 1
    drift = {(r.field, r.before, r.after) for r in inferred.drift(stored).collect()}
    assert ("w", None, "array<bigint>") in drift and ("w", "array<bigint>", "string") in drift
    assert ("z", None, "string") in drift and ("n", None, "struct<k: bigint>") in drift
    assert sum(f == "u" for f, _, _ in drift) == 1


def test_nothing_found(spark, tmp_path):
    empty = spark.createDataFrame([], inferred.FOUND)
    assert inferred.fields(empty).collect() == [] and len(inferred.schema(empty)) == 0
    assert inferred.found(spark.createDataFrame([], TEXT)).collect() == []


def test_odd_names(spark):
    rows = [("f", None, '{"a b":1,"":2,"c`d":"x"}')]
    found = inferred.found(spark.createDataFrame(rows, TEXT))
    assert {r.field for r in found.collect()} == {None, "a b", "", "c`d"}
    kept = inferred.schema(found.where("field is null or field != ''"))
    assert kept.fieldNames() == ["a b", "c`d"]
