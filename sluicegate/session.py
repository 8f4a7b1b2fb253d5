"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings that results or large jobs gain from; a session made otherwise gives the same results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Writes split by class or by outcome keep one open file per value instead of sorting first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # The JVM does not compile methods above 8000 bytes, and tables with many columns generate such.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call sites are not recorded for every column expression; plans for many tables build faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tuned_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sluicegate-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def working_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, without Python workers."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.names]
    return spark.createDataFrame(pa.table(dict(zip(schema.names, columns))), schema)


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Keep a small derived table in the shared folder so that later uses do not recompute it."""
    shared_folder(spark)
    return df.checkpoint(eager=True)
