"""What is wrong with a message: fields that are absent, null, of another type, too large.

The text is parsed once into a variant, which keeps what JSON said; every field is then
looked up in it. ``silver.parse`` gives null for all of these alike.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
)

from staywise.schemas import CUSTOMER_EVENT

#: States of a field, and of a whole message under the name ``WHOLE``.
ABSENT, NULL, WRONG_TYPE, OVERFLOW = "absent", "null", "wrong_type", "overflow"
EMPTY, MALFORMED, NO_OBJECT = "empty", "malformed", "no_object"
WHOLE = "message"

_WHOLE_NUMBERS = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONS = (FloatType, DoubleType)


def _object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))


def _as_declared(value: Column, said: Column, kind: DataType) -> Column:
    """Whether a field whose variant schema is ``said`` is of the JSON kind of ``kind``: a
    number, whole or not (of any size), a string, a boolean."""
    if isinstance(kind, _WHOLE_NUMBERS):
        # Beyond 64 bits, whole numbers are decimals.
        return (said == "BIGINT") | (said.rlike(r"^DECIMAL\(\d+,0\)$") & ~_has_point(value))
    if isinstance(kind, _FRACTIONS):
        return said.isin("BIGINT", "DOUBLE") | said.startswith("DECIMAL")
    return said == ("STRING" if isinstance(kind, StringType) else "BOOLEAN")


def _has_point(value: Column) -> Column:
    """Whether a decimal without digits behind the point was written like 5.0: small enough
    for 64 bits, which a number without a point would have been kept in."""
    return F.try_variant_get(value, "$", "bigint").isNotNull()


def _state(value: Column, said: Column, typed: Column, kind: DataType) -> Column:
    """Null if the field is as declared; ``typed`` is its value as ``kind``."""
    if isinstance(kind, (*_WHOLE_NUMBERS, *_FRACTIONS, StringType, BooleanType)):
        state = F.when(~_as_declared(value, said, kind), WRONG_TYPE)
        if isinstance(kind, _WHOLE_NUMBERS):
            state = state.when(typed.isNull(), OVERFLOW)
        elif isinstance(kind, _FRACTIONS):
            state = state.when(typed.isNull() | typed.isin(float("inf"), float("-inf")), OVERFLOW)
    else:
        state = F.when(typed.isNull(), WRONG_TYPE)
    return F.when(value.isNull(), ABSENT).when(F.is_variant_null(value), NULL).otherwise(state)


def _step(df: DataFrame, keep, **columns: Column) -> DataFrame:
    """``keep…`` and ``columns``, worked out once per row.

    One row in, one row out: unlike a projection, which Spark merges with those above and
    repeats for each use of a column, or for a filter on it.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def read(
    df: DataFrame, schema: StructType = CUSTOMER_EVENT, column: str = "raw_json", keep=()
) -> DataFrame:
    """JSON text to ``keep…``, the columns of ``schema``, ``defects`` and ``unknown``.

    ``defects`` lists ``field`` and ``state`` for each field that is not as declared, which
    is then null. A number has to be a JSON number, a whole one without a point and of at
    most 38 digits; a text has to be a string. A message that is null or blank, no JSON, or no object has one defect,
    ``WHOLE``, and only nulls. ``unknown`` names the fields that ``schema`` does not have, in
    order of their names. Names are told apart by case. A field that occurs twice makes the
    message malformed.
    """
    text, n = F.col(column), range(len(schema))
    parsed = _step(
        df,
        keep,
        _parsed=F.try_parse_json(text),
        _empty=F.when(~F.coalesce(text, F.lit("")).rlike(r"\S"), EMPTY),
    )
    whole = (
        F.when(F.col("_empty").isNotNull(), F.col("_empty"))
        .when(F.col("_parsed").isNull(), MALFORMED)
        .when(~_object(F.col("_parsed")), NO_OBJECT)
    )
    judged = _step(parsed, [*keep, "_parsed"], _whole=whole)
    values = [
        F.when(F.col("_whole").isNull(), F.try_variant_get("_parsed", f"$['{f.name}']", "variant"))
        for f in schema
    ]
    kept = [*keep, "_parsed", "_whole"]
    found = _step(judged, kept, **{f"_value{i}": values[i] for i in n})
    kept += [f"_value{i}" for i in n]
    said = _step(found, kept, **{f"_said{i}": F.schema_of_variant(f"_value{i}") for i in n})
    typed = {
        f"_typed{i}": F.try_variant_get(f"_value{i}", "$", f.dataType.simpleString())
        for i, f in enumerate(schema)
    }
    kept += [f"_said{i}" for i in n]
    known = _step(said, kept, **typed)
    states = {
        f"_state{i}": _state(
            F.col(f"_value{i}"), F.col(f"_said{i}"), F.col(f"_typed{i}"), f.dataType
        )
        for i, f in enumerate(schema)
    }
    stated = _step(known, ["*"], **states)
    listed = F.array(*[
        F.struct(F.lit(f.name).alias("field"), F.col(f"_state{i}").alias("state"))
        for i, f in enumerate(schema)
    ])
    defects = F.when(
        F.col("_whole").isNull(), F.filter(listed, lambda x: x["state"].isNotNull())
    ).otherwise(F.array(F.struct(F.lit(WHOLE).alias("field"), F.col("_whole").alias("state"))))
    names = F.map_keys(F.try_variant_get("_parsed", "$", "map<string, variant>"))
    declared = F.array(*[F.lit(f.name) for f in schema])
    unknown = F.when(F.col("_whole").isNull(), F.array_sort(F.array_except(names, declared)))
    return stated.select(
        *keep,
        *[
            F.when(F.col(f"_state{i}").isNull(), F.col(f"_typed{i}")).alias(f.name)
            for i, f in enumerate(schema)
        ],
        defects.alias("defects"),
        F.coalesce(unknown, F.array().cast("array<string>")).alias("unknown"),
    )


def clean(df: DataFrame) -> DataFrame:
    """Rows of ``read`` without a defect, as plain columns."""
    return df.where(F.size("defects") == 0).drop("defects", "unknown")


def faulty(df: DataFrame, allowed: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a defect in a state that is not ``allowed``, for a table of their own."""
    states = F.transform("defects", lambda x: x["state"])
    allow = reduce(lambda a, s: F.array_remove(a, s), allowed, states)
    return df.where(F.size(allow) > 0)


def counts(df: DataFrame) -> DataFrame:
    """``field, state, n``: rows per field and state."""
    return (
        df.select(F.inline("defects")).groupBy("field", "state").agg(F.count("*").alias("n"))
    )
