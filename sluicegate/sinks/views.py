"""SQL views of what is committed.

A view shows a table's declared columns and only the generations that the ledger has as committed: everything up
to the last round in which control rows were put together, and after that what a ledger row names. Both parts
prune the ``_gen`` partitions, the first by a scalar and the second by a semi join. The ledger is read by path, so
every query sees it as it is then, in any session of the same catalog, whatever has been flushed since.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.sql_text import literal, quoted
from ..operators.registry import TableSchema
from ..operators.typing import REJECTED
from ..schemas import LEDGER
from ..session import local_rows
from .control import BEFORE_ALL, COMPLETE, ControlTable, create_if_absent, exists, overwrite
from .targets import GENERATION, FolderTarget, NameTaken, Target, ensure_namespace

SUFFIX = "__committed"
OWNER = "sluicegate.table"


def view_namespace(schema: TableSchema) -> str:
    """One name of the session catalog. Namespace parts may not hold ``__`` there, so no table's own namespace meets it."""
    return "__".join(schema.namespace) + SUFFIX


def view_name(schema: TableSchema) -> str:
    return quoted(view_namespace(schema), schema.table)


def ready_for_views(spark: SparkSession, ledger: ControlTable) -> None:
    """Both parts of the ledger need a file before the first commit, or no view over them can be planned."""
    if exists(spark, f"{ledger.path}/merged/upto={BEFORE_ALL}/{COMPLETE}") or ledger.merged_upto(spark) is not None:
        return
    nothing = local_rows(spark, [(BEFORE_ALL, None, None, False)], LEDGER).select(*ledger.names)
    ledger.replace(nothing, BEFORE_ALL)
    folder = f"{ledger.path}/merged/upto={BEFORE_ALL}"
    overwrite(nothing, folder)
    create_if_absent(spark, f"{folder}/{COMPLETE}")


def committed_sql(target: Target, schema: TableSchema, ledger: ControlTable) -> str:
    def files(path: str) -> str:
        return f"parquet.{quoted(path)}"

    columns = ", ".join(quoted(f.name) for f in schema.fields)
    folder = isinstance(target, FolderTarget)
    source = files(target.place(schema)) if folder else target.place(schema)
    good = f"NOT {REJECTED} AND " if folder else ""
    closed = f"(SELECT max(upto) FROM {files(f'{ledger.path}/merged')})"
    named = f"SELECT gen FROM {files(f'{ledger.path}/recent')} WHERE `table` = {literal(schema.table)} AND committed"
    return (
        f"SELECT {columns} FROM {source} WHERE {good}{GENERATION} <= {closed} "
        f"UNION ALL SELECT {columns} FROM {source} WHERE {good}{GENERATION} > {closed} AND {GENERATION} IN ({named})"
    )


def publish(spark: SparkSession, target: Target, schema: TableSchema, ledger: ControlTable, location: str | None = None) -> str:
    """Create the view of a table that has files; its quoted name. A view that is there stays as it is.

    The session catalog folds case: of two folder tables that differ in case only, the one published first has
    the name, and the other raises ``NameTaken``.
    """
    name = view_name(schema)
    if spark.catalog.tableExists(name):
        owner = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(OWNER)
        if owner != schema.table:
            raise NameTaken(f"the view of table '{schema.table}' has the place of table '{owner}'")
        return name
    ready_for_views(spark, ledger)
    ensure_namespace(spark, (view_namespace(schema),), location)
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name} TBLPROPERTIES ({literal(OWNER)} = {literal(schema.table)}) AS {committed_sql(target, schema, ledger)}")
    return name
