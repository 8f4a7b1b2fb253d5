"""Declared field types: name resolution and the cast of each payload value.

A payload is first parsed with every value as text. A value that is present but does not cast is then
a *bad value*, which is kept apart from a payload that does not parse at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of the ten field types. Matching is exact and case-sensitive.
SPELLINGS = {
    "string": "string",
    "long": "long",
    "int64": "long",
    "int": "int",
    "int32": "int",
    "double": "double",
    "float64": "double",
    "float": "float",
    "float32": "float",
    "boolean": "boolean",
    "timestamptz": "timestamptz",
    "timestamp": "timestamp",
    "date": "date",
    "binary": "binary",
    "bytes": "binary",
}

SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamptz": T.TimestampType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}

FALLBACK = "string"

# No backslashes: these go into SQL text.
_INTEGER = "^-?[0-9]+$"
_CLOCK = "[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?"
_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_NAIVE = f"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ]{_CLOCK})?$"
_INSTANT = f"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]{_CLOCK}([Zz]|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$"


def resolve(spelling: str) -> str:
    """Field type for a spelling; unknown spellings are text."""
    return SPELLINGS.get(spelling, FALLBACK)


def resolve_column(spelling: Column) -> Column:
    return F.coalesce(_spelling_lookup(spelling), F.lit(FALLBACK))


def is_unknown(spelling: Column) -> Column:
    return _spelling_lookup(spelling).isNull()


def _spelling_lookup(spelling: Column) -> Column:
    pairs = [F.lit(x) for pair in SPELLINGS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), spelling)


def _case(*branches: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + " END"


def _floating(x: str, target: str) -> str:
    # Java reads a trailing type letter ("1d"); a JSON number never has one.
    plain = f"right({x}, 1) NOT IN ('d', 'D', 'f', 'F') OR endswith(lower({x}), 'inf')"
    return _case((plain, f"try_cast({x} AS {target})"))


def _instant(x: str) -> str:
    """Micros or ISO text; text without an offset is UTC whatever the session time zone is."""
    timed = f"if(length({x}) = 10, concat({x}, 'T00:00:00'), {x})"
    return _case(
        (f"rlike({x}, '{_NAIVE}')", f"try_cast(concat({timed}, '+00:00') AS TIMESTAMP)"),
        (f"rlike({x}, '{_INSTANT}')", f"try_cast(upper({x}) AS TIMESTAMP)"),
        (f"rlike({x}, '{_INTEGER}')", f"timestamp_micros(try_cast({x} AS BIGINT))"),
    )


def _from_epoch(micros: str) -> str:
    return f"timestampadd(MICROSECOND, {micros}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def _naive(x: str) -> str:
    """As an instant, then its UTC wall-clock value; plain text needs no zone arithmetic."""
    return _case(
        (f"rlike({x}, '{_NAIVE}')", f"try_cast({x} AS TIMESTAMP_NTZ)"),
        (f"rlike({x}, '{_INSTANT}')", _from_epoch(f"unix_micros(try_cast(upper({x}) AS TIMESTAMP))")),
        (f"rlike({x}, '{_INTEGER}')", _from_epoch(f"try_cast({x} AS BIGINT)")),
    )


def _day(x: str) -> str:
    return _case(
        (f"rlike({x}, '{_DAY}')", f"try_cast({x} AS DATE)"),
        (f"rlike({x}, '{_INTEGER}')", f"date_from_unix_date(try_cast({x} AS INT))"),
    )


def cast_sql(x: str, field_type: str) -> str:
    """SQL for the payload text ``x`` as the declared type; null when it does not fit.

    SQL text rather than columns: a job with many tables builds many of these on the driver, and Spark
    parses a whole select list in one call.
    """
    if field_type == "string":
        return x
    if field_type == "long":
        return f"try_cast({x} AS BIGINT)"
    if field_type == "int":
        return f"try_cast({x} AS INT)"
    if field_type in ("double", "float"):
        return _floating(x, field_type)
    if field_type == "boolean":
        return _case((f"{x} = 'true'", "true"), (f"{x} = 'false'", "false"))
    if field_type == "timestamptz":
        return _instant(x)
    if field_type == "timestamp":
        return _naive(x)
    if field_type == "date":
        return _day(x)
    if field_type == "binary":
        # unhex pads odd-length text, so that is ruled out first.
        return _case((f"length({x}) % 2 = 0", f"unhex({x})"))
    raise ValueError(f"not a field type: {field_type!r}")
