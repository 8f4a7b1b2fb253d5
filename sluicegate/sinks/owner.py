"""One job at a time works on a root: a file with the job's name, created only where there is none."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..options import IngestOptions
from .control import create_if_absent, remove


class RootTaken(RuntimeError):
    """Another job works on this root, or ended without giving it back."""


def _file(options: IngestOptions) -> str:
    return f"{options.root.rstrip('/')}/control/owner"


def holder(spark: SparkSession, options: IngestOptions) -> str | None:
    rows = spark.read.text(_file(options), wholetext=True).collect()
    return rows[0]["value"] if rows else ""


def claim(spark: SparkSession, options: IngestOptions) -> None:
    """Take the root for ``options.owner``. The same name may take it again, as a job does that starts after a crash."""
    if options.owner is None or create_if_absent(spark, _file(options), options.owner):
        return
    if (now := holder(spark, options)) != options.owner:
        raise RootTaken(f"'{options.root}' belongs to job '{now}', not to '{options.owner}'")


def release(spark: SparkSession, options: IngestOptions) -> None:
    """Give the root back at the end of a job, or for a job that is known to be gone."""
    if options.owner is not None:
        claim(spark, options)
        remove(spark, _file(options))
