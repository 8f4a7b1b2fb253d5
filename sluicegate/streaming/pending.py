"""What a job has still to do: generations its stream has begun and not closed, and their tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.decode import RECORD
from ..operators.generations import pending
from ..plans.flush import RECORD_CLASS, Store
from ..schemas import STAGED
from ..session import local_rows
from ..sinks.control import read_or_empty

GEN = T.StructType([T.StructField("gen", T.LongType())])


def logged_batches(spark: SparkSession, checkpoint: str, log: str) -> DataFrame:
    """``gen`` of each batch in the stream's ``offsets`` or ``commits`` log, from the names of its files.

    Spark keeps a bounded number of batches in these logs. No file is opened.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/{log}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_rows(spark, [], GEN)
    number = F.regexp_extract("path", r"/(\d+)(\.compact)?$", 1)
    return files.select(F.when(number != "", number).cast("bigint").alias("gen")).where("gen IS NOT NULL")


def open_generations(spark: SparkSession, root: str) -> DataFrame:
    """``gen`` of the generations of a job that began and are not closed."""
    checkpoint = f"{root.rstrip('/')}/checkpoint"
    done = logged_batches(spark, checkpoint, "commits").withColumn("committed", F.lit(True))
    return pending(logged_batches(spark, checkpoint, "offsets"), done)


def open_tables(spark: SparkSession, root: str) -> DataFrame:
    """``gen, table, records``: registered tables of open generations that are not committed, with their staged records.

    A generation that failed before its frames were staged has no rows here, though it is open.
    """
    store, found = Store(root), local_rows(spark, [], T.StructType([*GEN.fields, T.StructField("table", T.StringType()), T.StructField("records", T.LongType())]))
    # A stream has one batch open at a time, and two while it moves on.
    for gen in sorted(r["gen"] for r in open_generations(spark, root).toLocalIterator()):
        staged = read_or_empty(spark, f"{store.staged(gen)}/class={RECORD_CLASS}", STAGED, base=store.staged(gen)).where(F.col("kind") == RECORD)
        counted = staged.groupBy("table").agg(F.count(F.lit(1)).alias("records"))
        committed = store.ledger.read_one(spark, gen).where("committed").select("table")
        left = counted.join(store.registry(spark, gen).select("table"), "table", "left_semi").join(committed, "table", "left_anti")
        found = found.unionByName(left.withColumn("gen", F.lit(gen).cast("bigint")).select("gen", "table", "records"))
    return found
