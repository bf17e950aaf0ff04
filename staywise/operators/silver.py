"""Second hop: text to typed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staywise.schemas import CUSTOMER_EVENT


def parse(
    df: DataFrame, schema: StructType = CUSTOMER_EVENT, column: str = "raw_json", keep=()
) -> DataFrame:
    """JSON text to the columns of ``schema``.

    Permissive: text that is no JSON object becomes a row of nulls, a field of the
    wrong type becomes null alone. Rows are never dropped here; ``quality`` tells
    them apart.

    The struct is unfolded by ``inline`` rather than ``parsed.*``: a later filter on
    the fields would otherwise be pushed below the parsing, one more parse per field.
    """
    parsed = F.array(F.from_json(F.col(column), schema))
    return df.select(*keep, F.inline(parsed))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order."""
    return df.select(*schema.fieldNames())


def coerce(df: DataFrame, schema: StructType, keep=()) -> DataFrame:
    """Columns of ``schema`` in its types; what cannot be converted becomes null.

    For tables that arrive with other types, such as inferred JSON (``BIGINT``).
    """
    return df.select(
        *keep, *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )
