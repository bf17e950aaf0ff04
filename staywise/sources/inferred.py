"""The schema of JSON files as a table that grows with the files.

What each file holds is found once, when the file is new, and stored: per top-level field the
type that takes all its values, how many there are, how many are null. Schemas of any set of
files are merged from those rows, in any order, so files are never read again for it. Batches
in which a field appears or its type gets wider are drift.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from staywise.sinks import batches
from staywise.sinks.file_tables import DRAIN

#: One row per file and field; a null ``field`` stands for the lines of the file themselves.
FOUND = StructType([
    StructField("file", StringType()),
    StructField("modified", TimestampType()),
    StructField("field", StringType()),
    StructField("type", StringType()),
    StructField("n", LongType()),
    StructField("n_null", LongType()),
])


def found(lines: DataFrame) -> DataFrame:
    """``FOUND`` rows of ``file, modified, value``: one parse per line, counted per task first.

    For the lines themselves ``n_null`` counts those that are no JSON object.
    """
    parsed = lines.select(
        "file", "modified", F.inline(F.array(F.struct(F.try_parse_json("value").alias("line"))))
    ).select("*", F.try_variant_get("line", "$", "map<string, variant>").alias("fields"))
    whole = F.struct(
        F.lit(None).cast("string").alias("field"),
        F.when(F.col("fields").isNotNull(), F.col("line")).alias("value"),
    )
    each = F.transform(
        F.coalesce(F.map_entries("fields"), F.array().cast("array<struct<key: string, value: variant>>")),
        lambda x: F.struct(x["key"].alias("field"), x["value"].alias("value")),
    )
    empty = F.col("value").isNull() | F.is_variant_null("value")
    return (
        parsed.select("file", "modified", F.inline(F.concat(F.array(whole), each)))
        .groupBy("file", "modified", "field")
        .agg(
            F.schema_of_variant_agg("value").alias("type"),
            F.count("*").alias("n"),
            F.count_if(empty).alias("n_null"),
        )
    )


def update(spark: SparkSession, path: str, store: str, **options) -> StreamingQuery:
    """Read the files of ``path`` that are new and add what they hold to ``store``.

    Which files are known is the stream's own checkpoint, beside the store. ``options`` bound
    a batch, such as ``maxFilesPerTrigger``.
    """
    lines = spark.readStream.format("text").options(**options).load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        "value",
    )

    def each(rows: DataFrame, number: int) -> None:
        batches.write(found(rows), store, batches.current(rows, number))

    query = (
        lines.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{store}-checkpoint")
        .trigger(**DRAIN)
        .start()
    )
    query.awaitTermination()
    return query


def stored(spark: SparkSession, store: str, keep=()) -> DataFrame:
    return batches.read(spark, store, FOUND, keep=keep)


def _merged(types: Column) -> Column:
    """The narrowest type for values of all ``types``; that of an aggregate over all values.

    Whole numbers fit into decimals, decimals into doubles; nulls into anything; whatever
    else differs, nested types included, is a variant.
    """
    types = F.array_remove(types, "VOID")
    number = r"^(BIGINT|DOUBLE|DECIMAL\((\d+),(\d+)\))$"

    def digits(t, group):
        found = F.regexp_extract(t, number, group).try_cast("int")
        # A whole number has up to 20 digits.
        return F.when(t == "BIGINT", 20 if group == 2 else 0).otherwise(found)

    scale = F.array_max(F.transform(types, lambda t: digits(t, 3)))
    before = F.array_max(F.transform(types, lambda t: digits(t, 2) - digits(t, 3)))
    decimal = F.format_string("DECIMAL(%d,%d)", before + scale, scale)
    return (
        F.when(F.size(types) == 0, "VOID")
        .when(F.size(types) == 1, types[0])
        .when(~F.forall(types, lambda t: t.rlike(number)), "VARIANT")
        .when(F.array_contains(types, "DOUBLE") | (before + scale > 38), "DOUBLE")
        .otherwise(decimal)
    )


def spark_type(kind: Column) -> Column:
    """A variant's type as Spark reads JSON: fractions as doubles, what is mixed as text."""
    kind = F.regexp_replace(kind, r"\bDECIMAL\(\d+,\d+\)", "DOUBLE")
    kind = F.regexp_replace(kind, r"\b(VARIANT|VOID)\b", "STRING")
    return F.lower(F.regexp_replace(kind, r"\bOBJECT<", "STRUCT<"))


def fields(files: DataFrame) -> DataFrame:
    """``field, type, n, n_null, n_absent`` over all lines that are objects.

    ``n`` counts values that are not null. ``type`` is Spark's; nested names are in lower case.
    """
    lines = files.where(F.col("field").isNull()).agg(
        F.coalesce(F.sum(F.col("n") - F.col("n_null")), F.lit(0)).alias("lines")
    )
    return (
        files.where(F.col("field").isNotNull())
        .groupBy("field")
        .agg(F.collect_set("type").alias("types"), F.sum("n").alias("all"), F.sum("n_null").alias("n_null"))
        .select(
            "field",
            spark_type(_merged(F.col("types"))).alias("type"),
            (F.col("all") - F.col("n_null")).alias("n"),
            "n_null",
            (lines.scalar() - F.col("all")).alias("n_absent"),
        )
    )


def schema(files: DataFrame) -> StructType:
    """The merged fields in order of their names, as a schema to read the files with.

    The fields of a table are few, and the reader needs them on the driver.
    """
    listed = sorted(fields(files).select("field", "type").collect())
    quoted = ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in listed)
    return StructType.fromDDL(quoted) if listed else StructType()


def drift(files: DataFrame) -> DataFrame:
    """``field, batch_id, before, after``: where a field appeared (``before`` null) or its type
    had to be widened. ``files`` carries ``batch_id``."""
    per_batch = (
        files.where(F.col("field").isNotNull())
        .groupBy("field", "batch_id")
        .agg(F.collect_set("type").alias("types"))
    )
    upto = W.partitionBy("field").orderBy("batch_id")
    met = lambda last: F.flatten(
        F.collect_list("types").over(upto.rowsBetween(W.unboundedPreceding, last))
    )
    kinds = per_batch.select(
        "field", "batch_id", F.array_distinct(met(-1)).alias("old"), F.array_distinct(met(0)).alias("new")
    )
    before = F.when(F.size("old") > 0, spark_type(_merged(F.col("old"))))
    return kinds.select(
        "field", "batch_id", before.alias("before"), spark_type(_merged(F.col("new"))).alias("after")
    ).where(~F.col("before").eqNullSafe(F.col("after")))
