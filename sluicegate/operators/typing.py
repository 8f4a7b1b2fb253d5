"""Payload text to typed columns, and the rows that do not make it.

Two kinds of failure stay apart. A payload that does not parse is *malformed* and is set aside under
every policy. A parsed payload with a missing required value or a value of the wrong type is *bad*: it
is set aside under ``quarantine`` and stops the job under ``fail``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.field_types import FALLBACK, SPARK_TYPES, cast_sql, resolve_column
from ..functions.sql_text import literal, quoted
from ..schemas import REJECTS
from .barrier import filterable
from .registry import Field, TableSchema, with_schema

MALFORMED = "malformed payload"
NOT_AN_OBJECT = "payload is not an object"
NO_SCHEMA = "no schema registered"
REJECT = "_reject"
REJECTED = "_rejected"
QUARANTINE = "quarantine"
FAIL = "fail"
PARSE_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
UNPARSED = (
    "CASE WHEN NOT startswith(ltrim(payload), '{') AND try_parse_json(payload) IS NOT NULL "
    f"THEN {literal(NOT_AN_OBJECT)} ELSE {literal(MALFORMED)} END"
)


class AmbiguousFields(ValueError):
    """A registration declares the same column twice."""


def missing_required(name: str) -> str:
    return f"missing required field '{name}'"


def bad_value(name: str) -> str:
    return f"bad value for '{name}'"


def check_fields(fields: Sequence[Field], case_sensitive: bool) -> None:
    names = [f.name if case_sensitive else f.name.lower() for f in fields]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise AmbiguousFields(f"columns declared more than once: {repeated}")


def _broken_column(fields: Sequence[Field]) -> str:
    name = "_broken"
    taken = {f.name.lower() for f in fields}
    while name in taken:
        name = "_" + name
    return name


def parse_object(payload: Column, fields: Sequence[Field]) -> Column:
    """Payload as a struct of texts, declared keys only, plus the broken-payload marker."""
    broken = _broken_column(fields)
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    return F.from_json(payload, schema.add(broken, T.StringType()), {**PARSE_OPTIONS, "columnNameOfCorruptRecord": broken})


def _values_sql(parsed: str, fields: Sequence[Field]) -> list[str]:
    """SQL for each declared column."""
    return [cast_sql(f"{parsed}.{quoted(f.name)}", f.resolved) for f in fields]


def _reason_sql(parsed: str, fields: Sequence[Field], values: Sequence[str]) -> str:
    """SQL for the first reason to set a row aside, in field order; ``values`` are the cast columns."""
    texts = [f"{parsed}.{quoted(f.name)}" for f in fields]
    broken = f"{parsed}.{quoted(_broken_column(fields))}"
    checks = [f"WHEN {parsed} IS NULL OR {broken} IS NOT NULL THEN {UNPARSED}"]
    for field, text, value in zip(fields, texts, values):
        if field.required:
            checks.append(f"WHEN {text} IS NULL THEN {literal(missing_required(field.name))}")
        if field.resolved != "string":
            checks.append(f"WHEN {text} IS NOT NULL AND {value} IS NULL THEN {literal(bad_value(field.name))}")
    return f"CASE {' '.join(checks)} END"


def _typed(records: DataFrame, schema: TableSchema) -> DataFrame:
    """Records with typed columns ``_c0..`` and the ``_reason`` they would be set aside for, if any."""
    fields = schema.fields
    case_sensitive = records.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    check_fields(fields, case_sensitive)
    parsed = records.select("seq", "table", "payload", "frame", parse_object(F.col("payload"), fields).alias("_p"))
    names = [f"_c{i}" for i in range(len(fields))]
    # Cast in one select and judge in the next, so that no cast is planned twice.
    columns = [f"{value} AS {name}" for value, name in zip(_values_sql("_p", fields), names)]
    cast = parsed.selectExpr("seq", "table", "payload", "frame", "_p", *columns)
    return cast.selectExpr("seq", "table", "payload", "frame", *names, f"{_reason_sql('_p', fields, names)} AS _reason")


def _judged(records: DataFrame, schema: TableSchema) -> DataFrame:
    """``_typed`` with a ``reason`` that can be filtered on without parsing twice."""
    return filterable(_typed(records, schema), "_reason", "reason")


def _declared(schema: TableSchema) -> list[str]:
    return [f"_c{i} AS {quoted(f.name)}" for i, f in enumerate(schema.fields)]


def check_policy(on_bad_row: str) -> None:
    if on_bad_row not in (QUARANTINE, FAIL):
        raise ValueError(f"on_bad_row is {QUARANTINE!r} or {FAIL!r}, not {on_bad_row!r}")


def _is_set_aside(reason: Column, schema: TableSchema, on_bad_row: str) -> Column:
    """True for rows to set aside; under ``fail`` a bad row raises instead."""
    if on_bad_row == QUARANTINE:
        return reason.isNotNull()
    stop = F.raise_error(F.concat(F.lit(f"table '{schema.table}': "), reason)).cast("boolean")
    return F.when(reason.isNotNull() & (reason != MALFORMED), stop).otherwise(reason.isNotNull())


def typed_rows(records: DataFrame, schema: TableSchema, on_bad_row: str = QUARANTINE, ordered: bool = False) -> DataFrame:
    """Good records as the declared columns, in declared order.

    ``ordered`` sorts inside each partition by ``seq``, which needs no shuffle.
    """
    check_policy(on_bad_row)
    good = _judged(records, schema).where(~_is_set_aside(F.col("reason"), schema, on_bad_row))
    if ordered:
        good = good.sortWithinPartitions("seq")
    return good.selectExpr(*_declared(schema))


def rejected_rows(records: DataFrame, schema: TableSchema) -> DataFrame:
    """Records that are malformed or bad, whole, with the first reason in declared field order."""
    return _judged(records, schema).where(F.col("reason").isNotNull()).select(*REJECTS.names)


def split_rows(records: DataFrame, schema: TableSchema, on_bad_row: str = QUARANTINE, ordered: bool = False) -> DataFrame:
    """Good and set-aside records together, for one write that separates them by ``_rejected``.

    Declared columns, then ``_reject`` with the whole record and its reason where it is set aside.
    """
    check_policy(on_bad_row)
    typed = _typed(records, schema)
    reason = F.col("_reason")
    reject = F.struct("seq", "table", "payload", "frame", reason.alias("reason"))
    split = typed.select(
        "*",
        F.when(reason.isNotNull(), reject).alias(REJECT),
        _is_set_aside(reason, schema, on_bad_row).alias(REJECTED),
    )
    if ordered:
        split = split.sortWithinPartitions(REJECTED, "seq")
    return split.selectExpr(*_declared(schema), REJECT, REJECTED)


def unregistered_rows(looked_up: DataFrame) -> DataFrame:
    """Records whose table has no schema, as rejects."""
    dropped = looked_up.where(F.col("fields").isNull())
    return dropped.select("seq", "table", "payload", "frame", F.lit(NO_SCHEMA).alias("reason"))


# A payload that repeats a key has its last value, as typed columns have; others are looked up as they were parsed.
_LAST_WINS = """
CASE WHEN size(_m) = size(array_distinct(map_keys(_m))) THEN _m
     ELSE map_from_entries(filter(reverse(map_entries(_m)),
       (e, i) -> array_position(transform(reverse(map_entries(_m)), x -> x.key), e.key) = i + 1)) END"""
# Lambda bodies see one declared field with its payload text as ``r``.
_TYPE_FAILS = " ".join(
    f"WHEN {literal(t)} THEN ({cast_sql('r.text', t)}) IS NULL" for t in SPARK_TYPES if t != FALLBACK
)
_FIRST_REASON = f"""
get(filter(transform(
  transform(fields, f -> named_struct('name', f.name, 'type', f.type, 'required', f.required,
    'text', try_element_at(_m, f.name))),
  r -> CASE WHEN r.required AND r.text IS NULL THEN concat({literal("missing required field '")}, r.name, {literal("'")})
            WHEN r.text IS NOT NULL AND CASE r.type {_TYPE_FAILS} ELSE false END THEN concat({literal("bad value for '")}, r.name, {literal("'")}) END),
  reason -> reason IS NOT NULL), 0)"""


def with_reasons(admitted: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """Records of all tables with the ``reason`` each would be set aside for, and whether they are ``registered``.

    One scan at any number of tables: payloads are parsed as maps, and the declared fields come as data
    from the registry and are judged in declared order.
    """
    fields = F.transform(
        "fields", lambda f: F.struct(f["name"].alias("name"), resolve_column(f["type"]).alias("type"), f["required"].alias("required"))
    )
    found = with_schema(admitted, registry_rows.select("table", "namespace", fields.alias("fields")))
    parsed = F.from_json("payload", "map<string, string>", PARSE_OPTIONS)
    rows = found.select(*admitted.columns, "fields", F.when(F.col("fields").isNotNull(), parsed).alias("_m"))
    rows = rows.withColumn("_m", F.expr(_LAST_WINS))
    reason = f"CASE WHEN fields IS NULL THEN NULL WHEN _m IS NULL THEN {UNPARSED} ELSE {_FIRST_REASON} END AS reason"
    return rows.selectExpr(*[quoted(c) for c in admitted.columns], "fields IS NOT NULL AS registered", reason)
