"""Run a registered query and its SQL on the same tables and compare the rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Type names of the two engines that count as the same.
_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql):
    """Empty text when names, types and rows agree, else what differs."""
    cursor = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _bag([d[0] for d in cursor.description], cursor.fetchall())
    types = {f.name: _TYPES[f.dataType.simpleString()] for f in df.schema}
    if types != expected_types:
        return f"schema {types} expected {expected_types}"
    found = _bag(df.columns, [tuple(r) for r in df.collect()])
    if found == expected:
        return ""
    extra, lacking = found - expected, expected - found
    return (
        f"{found.total()} rows, expected {expected.total()}; "
        f"extra {list(extra.items())[:2]}, lacking {list(lacking.items())[:2]}"
    )
