"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import working_folder


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared working folder and read it again.

    Cuts the lineage: a lost executor costs a re-read, and ids made by position or chance stay the same.
    """
    path = working_folder(df.sparkSession, label)
    df.write.option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have yet, whatever their case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
