"""Schema registrations and the registry made from them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.field_types import SPARK_TYPES, is_unknown, resolve, resolve_column
from .barrier import filterable
from .lookup import lookup

ENTRY = ("schema_id", "namespace", "fields")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True

    @property
    def resolved(self) -> str:
        return resolve(self.type)


@dataclass(frozen=True)
class TableSchema:
    """One registered table, as the driver needs it to build a plan."""

    table: str
    namespace: tuple[str, ...]
    fields: tuple[Field, ...]

    def struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, SPARK_TYPES[f.resolved], nullable=not f.required) for f in self.fields]
        )


def registration_document(body: Column) -> Column:
    """Registration JSON as a variant, or null when it does not parse."""
    # The brackets make trailing text after the object a parse error.
    whole = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    items = F.try_variant_get(whole, "$", "array<variant>")
    return F.when(F.size(items) == 1, items[0])


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("ABSENT"))


def _part(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def _parts(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "array<variant>")


def _all(items: Column, test) -> Column:
    return items.isNotNull() & F.coalesce(F.forall(items, test), F.lit(False))


def _valid_field(item: Column) -> Column:
    return (
        (_kind(_part(item, "$.name")) == "STRING")
        & (_kind(_part(item, "$.type")) == "STRING")
        & _kind(_part(item, "$.required")).isin("BOOLEAN", "ABSENT")
    )


def _valid(document: Column) -> Column:
    schema_id = _part(document, "$.schema_id")
    id_ok = _kind(schema_id).isin("ABSENT", "VOID") | (
        (_kind(schema_id) == "BIGINT") & F.try_variant_get(document, "$.schema_id", "int").isNotNull()
    )
    return (
        document.isNotNull()
        & (_kind(_part(document, "$.table")) == "STRING")
        & _all(_parts(document, "$.namespace"), lambda part: _kind(part) == "STRING")
        & _all(_parts(document, "$.fields"), _valid_field)
        & id_ok
    )


def document_is_valid(document: Column) -> Column:
    return F.coalesce(_valid(document), F.lit(False))


def registrations(decoded: DataFrame) -> DataFrame:
    """Registration frames parsed: ``seq, table, schema_id, namespace, fields, ok, payload, frame``.

    ``table``, ``namespace`` and ``fields`` must be there with the right types; ``required`` defaults to
    true and unknown keys are ignored.
    """
    documents = decoded.where((F.col("kind") == "01") & F.col("msg").isNull()).select(
        "seq", "payload", "frame", registration_document(F.col("payload")).alias("doc")
    )
    doc = F.col("doc")
    fields = F.transform(
        _parts(doc, "$.fields"),
        lambda f: F.struct(
            F.try_variant_get(f, "$.name", "string").alias("name"),
            F.try_variant_get(f, "$.type", "string").alias("type"),
            F.coalesce(F.try_variant_get(f, "$.required", "boolean"), F.lit(True)).alias("required"),
        ),
    )
    judged = filterable(documents.select("*", document_is_valid(doc).alias("_ok")), "_ok", "ok")
    only_ok = lambda value: F.when(F.col("ok"), value)
    return judged.select(
        "seq",
        only_ok(F.try_variant_get(doc, "$.table", "string")).alias("table"),
        only_ok(F.try_variant_get(doc, "$.schema_id", "int")).alias("schema_id"),
        only_ok(F.try_variant_get(doc, "$.namespace", "array<string>")).alias("namespace"),
        only_ok(fields).alias("fields"),
        "ok",
        "payload",
        "frame",
    )


def registry(registration_rows: DataFrame) -> DataFrame:
    """Newest registration per table, with the first and last ``seq`` it was registered at.

    The table name alone is the key: a second namespace for the same name replaces the first.
    """
    ok = registration_rows.where("ok")
    return merged(ok.select("table", F.col("seq").alias("first_seq"), F.col("seq").alias("last_seq"), *ENTRY))


def merged(parts: DataFrame) -> DataFrame:
    """Registry parts, such as one per generation, as one registry."""
    entry = F.struct(*ENTRY)
    # The JSON breaks ties, so that equal seq values give one answer on every run.
    order = F.struct(F.col("last_seq"), F.to_json(entry))
    newest = parts.groupBy("table").agg(
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
        F.max_by(entry, order).alias("entry"),
    )
    return newest.select("table", "first_seq", "last_seq", "entry.*")


def resolved_fields(registry_rows: DataFrame) -> DataFrame:
    """One row per declared field, with its resolved type and the rest of its registry row."""
    exploded = registry_rows.select("*", F.posexplode("fields").alias("pos", "field"))
    return exploded.select(
        *registry_rows.drop("fields").columns,
        (F.col("pos") + 1).alias("ordinal"),
        F.col("field.name").alias("name"),
        F.col("field.type").alias("declared_type"),
        resolve_column(F.col("field.type")).alias("resolved_type"),
        (~F.col("field.required")).alias("nullable"),
        is_unknown(F.col("field.type")).alias("unknown_type"),
    )


def table_schema(row) -> TableSchema:
    fields = tuple(Field(f["name"], f["type"], f["required"]) for f in row["fields"])
    return TableSchema(row["table"], tuple(row["namespace"]), fields)


def table_schemas(registry_rows: DataFrame) -> Iterator[TableSchema]:
    """Registered tables, fetched one partition at a time; there is one small row per table."""
    for row in registry_rows.select("table", "namespace", "fields").toLocalIterator():
        yield table_schema(row)


def with_schema(records: DataFrame, registry_rows: DataFrame, **limits: int) -> DataFrame:
    """Records with the newest ``namespace`` and ``fields`` of their table, null where it has none."""
    newest = registry_rows.select("table", "namespace", "fields")
    spread = F.coalesce(F.col("seq"), F.xxhash64("payload"))
    return lookup(records, newest, "table", spread, **limits)
