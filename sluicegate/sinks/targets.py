"""Typed tables as folders of Parquet or as catalog tables.

Both keep a ``_gen`` partition per flushed generation. A write replaces exactly that partition, so a
replayed generation overwrites itself and nothing else, also when it has no rows.

A folder table's records are parsed once: one write separates good rows from set-aside rows by a ``_rejected``
partition, and the set-aside half goes when the generation is closed. A catalog table takes its good rows
straight from the typed plan; only tables whose counts show that rows are missing are read again for rejects.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sql_text import literal, quoted
from ..operators.lookup import lookup
from ..operators.registry import TableSchema
from ..operators.typing import REJECT, REJECTED, split_rows, typed_rows
from ..schemas import REJECTS
from .control import exists, overwrite, read_or_empty, remove

GENERATION = "_gen"


class NameTaken(ValueError):
    """Another table already has this place; the catalog does not tell the two names apart."""


class SchemaChanged(ValueError):
    """A registration no longer matches the table it writes to. Tables do not evolve."""


def layout(struct: T.StructType) -> str:
    """Names and types of a table, without nullability."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in struct.fields)


def check_layout(schema: TableSchema, existing: str) -> None:
    declared = layout(schema.struct_type())
    if declared != existing:
        raise SchemaChanged(f"table '{schema.table}' has ({existing}) but ({declared}) is registered")


def check_target(schema: TableSchema) -> None:
    if not schema.namespace:
        raise ValueError(f"table '{schema.table}' is registered without a namespace")
    if not schema.table or not all(schema.namespace):
        raise ValueError("a table and each part of its namespace need a name")
    if not schema.fields:
        raise ValueError(f"table '{schema.table}' is registered without fields")
    taken = sorted({f.name for f in schema.fields if f.name.lower() in (GENERATION, REJECT, REJECTED)})
    if taken:
        raise ValueError(f"table '{schema.table}' may not declare {taken}")


def path_part(name: str) -> str:
    """A name as one path component; a dot is escaped too, so no name can climb out of its folder."""
    return quote(name, safe="").replace(".", "%2E")


def _table_folder(schema: TableSchema) -> str:
    return ".".join(path_part(p) for p in (*schema.namespace, schema.table))


REJECT_HALF = T.StructType([T.StructField(REJECT, REJECTS)])


class FolderTarget:
    """``<root>/tables/<namespace>.<table>/_gen=<n>/_rejected=<false or true>/*.parquet``."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def place(self, schema: TableSchema) -> str:
        return f"{self.root}/tables/{_table_folder(schema)}"

    def _folder(self, schema: TableSchema, gen: int) -> str:
        return f"{self.place(schema)}/{GENERATION}={gen}"

    def ensure(self, spark: SparkSession, schema: TableSchema, known: dict[str, str]) -> bool:
        """Check the table against its registration; true when it is new.

        A folder has no catalog entry, so ``known`` brings the layout of each place written before.
        """
        check_target(schema)
        existing = known.get(self.place(schema))
        if existing is not None:
            check_layout(schema, existing)
        return existing is None

    def folds_case(self, spark: SparkSession) -> bool:
        """Whether names that differ only in case are one place."""
        return False

    def prepared(self, records: DataFrame, schema: TableSchema, on_bad_row: str, ordered: bool) -> DataFrame:
        """What ``replace_generation`` writes: good and set-aside rows together."""
        return split_rows(records, schema, on_bad_row, ordered)

    def replace_generation(self, rows: DataFrame, schema: TableSchema, gen: int) -> None:
        overwrite(rows, self._folder(schema, gen), REJECTED)

    def counts(self, spark: SparkSession, schemas: Sequence[TableSchema], gen: int) -> dict[str, tuple[int, int]]:
        """Rows stored and rows set aside of each table, in one job over the written files' footers."""
        read = spark.read.schema(REJECT_HALF).option("recursiveFileLookup", "true")
        path = F.col("_metadata.file_path")
        part = F.regexp_extract(path, f"/tables/([^/]+)/{GENERATION}=[^/]+/{REJECTED}=(true|false)/", 1).alias("part")
        good = path.contains(f"/{REJECTED}=false/")
        written = read.parquet(*[self._folder(s, gen) for s in schemas])
        rows = written.groupBy(part).agg(F.count_if(good).alias("stored"), F.count_if(~good).alias("set_aside"))
        found = {unquote(r["part"]): (r["stored"], r["set_aside"]) for r in rows.toLocalIterator()}
        return {s.table: found.get(_table_folder(s), (0, 0)) for s in schemas}

    def _rejected_folder(self, schema: TableSchema, gen: int) -> str:
        return f"{self._folder(schema, gen)}/{REJECTED}=true"

    def has_rejects(self, spark: SparkSession, schema: TableSchema, gen: int) -> bool:
        return exists(spark, self._rejected_folder(schema, gen))

    def rejected(self, spark: SparkSession, schemas: Sequence[TableSchema], gen: int) -> DataFrame:
        """Records that were set aside, of all the tables in one read. Each has to have some."""
        read = spark.read.schema(REJECT_HALF).option("recursiveFileLookup", "true")
        return read.parquet(*[self._rejected_folder(s, gen) for s in schemas]).select(f"{REJECT}.*")

    def finish(self, spark: SparkSession, schema: TableSchema, gen: int) -> None:
        """Remove the set-aside half of a closed generation; its rejects are stored by then."""
        remove(spark, self._rejected_folder(schema, gen))

    def stored(self, spark: SparkSession, schema: TableSchema) -> DataFrame:
        """Every good row written, committed or not, with its ``_gen``."""
        partitions = [T.StructField(GENERATION, T.LongType()), T.StructField(REJECTED, T.BooleanType())]
        full = T.StructType([*schema.struct_type().fields, *partitions])
        return read_or_empty(spark, self.place(schema), full).where(~F.col(REJECTED)).drop(REJECTED)


def _template(name: str) -> str:
    """A name inside SQL text that Spark fills in, where braces mark what to fill."""
    return name.replace("{", "{{").replace("}", "}}")


def ensure_namespace(spark: SparkSession, parts: tuple[str, ...], location: str | None = None) -> str:
    """Create the namespace if absent; its quoted name."""
    name = quoted(*parts)
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{where}")
    return name


def ensure_table(spark: SparkSession, name: str, schema: TableSchema, provider: str = "parquet") -> bool:
    """Create the table from its registered fields if absent; true when it was created."""
    if spark.catalog.tableExists(name):
        columns = [f for f in spark.table(name).schema.fields if f.name != GENERATION]
        check_layout(schema, layout(T.StructType(columns)))
        return False
    columns = [
        f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.struct_type().fields
    ]
    columns.append(f"{GENERATION} BIGINT")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {provider} PARTITIONED BY ({GENERATION})"
    )
    return True


def append(rows: DataFrame, name: str) -> None:
    """Plain append by column name, for tables that are not replayed by generation."""
    rows.sparkSession.sql(f"INSERT INTO {_template(name)} BY NAME SELECT * FROM {{rows}}", rows=rows)


COUNTED_AT_ONCE = 64


class CatalogTarget:
    """Catalog tables. ``catalog`` names a Spark catalog, or is none for the session catalog.

    The session catalog has one-part namespaces, so longer ones are joined with ``__`` there; a part that
    contains ``__``, or begins or ends with ``_``, is refused. ``root`` is the job's own folder.
    """

    def __init__(self, root: str, catalog: str | None = None, provider: str = "parquet", location: str | None = None):
        self.root = root.rstrip("/")
        self.catalog = catalog
        self.provider = provider
        self.location = location.rstrip("/") if location else None

    def namespace(self, schema: TableSchema) -> tuple[str, ...]:
        if self.catalog:
            return (self.catalog, *schema.namespace)
        # Otherwise two namespaces could be joined to one name.
        if any("__" in part or part != part.strip("_") for part in schema.namespace):
            raise ValueError(f"namespace {list(schema.namespace)} has a part that contains '__', or begins or ends with '_'")
        return ("__".join(schema.namespace),)

    def place(self, schema: TableSchema) -> str:
        return quoted(*self.namespace(schema), schema.table)

    def folds_case(self, spark: SparkSession) -> bool:
        return spark.conf.get("spark.sql.caseSensitive") != "true"

    def ensure(self, spark: SparkSession, schema: TableSchema, known: dict[str, str]) -> bool:
        """Create what is missing; true when this place was not written before."""
        check_target(schema)
        namespace = self.namespace(schema)
        folder = f"{self.location}/{path_part(namespace[-1])}" if self.location else None
        ensure_namespace(spark, namespace, folder)
        ensure_table(spark, self.place(schema), schema, self.provider)
        return self.place(schema) not in known

    def prepared(self, records: DataFrame, schema: TableSchema, on_bad_row: str, ordered: bool) -> DataFrame:
        """What ``replace_generation`` writes: good rows only, in the declared columns."""
        return typed_rows(records, schema, on_bad_row, ordered)

    def replace_generation(self, rows: DataFrame, schema: TableSchema, gen: int) -> None:
        rows.sparkSession.sql(
            f"INSERT OVERWRITE {_template(self.place(schema))} PARTITION ({GENERATION} = {gen:d}) SELECT * FROM {{rows}}", rows=rows
        )

    def counts(self, spark: SparkSession, schemas: Sequence[TableSchema], gen: int) -> dict[str, tuple[int, int]]:
        """Rows stored of each table, ``COUNTED_AT_ONCE`` tables a job; what was set aside is not stored here."""
        found = {}
        for start in range(0, len(schemas), COUNTED_AT_ONCE):
            some = schemas[start : start + COUNTED_AT_ONCE]
            # Counted above the union, so that all tables share one aggregation.
            each = [f"SELECT {i} AS i FROM {self.place(s)} WHERE {GENERATION} = {gen:d}" for i, s in enumerate(some)]
            counted = spark.sql(f"SELECT i, count(*) AS n FROM ({' UNION ALL '.join(each)}) GROUP BY i").collect()
            found |= {s.table: (0, 0) for s in some} | {some[r["i"]].table: (r["n"], 0) for r in counted}
        return found

    def stored(self, spark: SparkSession, schema: TableSchema) -> DataFrame:
        return spark.table(self.place(schema))


Target = FolderTarget | CatalogTarget


def committed_rows(spark: SparkSession, target: Target, schema: TableSchema, ledger: DataFrame) -> DataFrame:
    """The table as readers see it: committed generations only, without ``_gen``."""
    done = ledger.where(F.col("committed") & (F.col("table") == schema.table)).select(F.col("gen").alias(GENERATION))
    stored = target.stored(spark, schema)
    # Measured, because the ledger's file size says little about its few rows; a broadcast also lets
    # Spark prune the generations that are not committed.
    return lookup(stored, done, GENERATION, F.xxhash64(*stored.columns), how="left_semi").drop(GENERATION)
