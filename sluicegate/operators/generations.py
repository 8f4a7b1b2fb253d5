"""Generations: the batches of buffered records that are flushed together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import generation_number


def numbered(names: DataFrame) -> DataFrame:
    """Rows with a ``name`` that is a generation name, with its ``number``; other names are dropped."""
    return names.withColumn("number", generation_number(F.col("name"))).where(F.col("number").isNotNull())


def newest(names: DataFrame) -> DataFrame:
    """The generation that keeps taking records, as one row ``name, number``."""
    top = numbered(names).agg(F.max_by("name", F.struct("number", "name")).alias("name"), F.max("number").alias("number"))
    return top.where(F.col("name").isNotNull())


def roles(names: DataFrame) -> DataFrame:
    """Each generation as ``active`` (the newest) or ``orphan`` (left by an earlier run)."""
    top = newest(names).select("name").scalar()
    return numbered(names).withColumn("role", F.when(F.col("name") == top, "active").otherwise("orphan"))


def closed(ledger: DataFrame) -> DataFrame:
    """Generations all of whose tables are committed."""
    flags = ledger.groupBy("gen").agg(F.bool_and(F.coalesce("committed", F.lit(False))).alias("all_committed"))
    return flags.where("all_committed").select("gen")


def pending(generations: DataFrame, ledger: DataFrame) -> DataFrame:
    """Generations seen but not closed, by number."""
    return generations.join(closed(ledger), "gen", "left_anti")


def work_list(orphans: DataFrame, frozen: DataFrame) -> DataFrame:
    """What one flush has to do: orphans oldest first, then the generation just frozen."""
    tagged = orphans.withColumn("turn", F.lit(0)).unionByName(frozen.withColumn("turn", F.lit(1)))
    return tagged.orderBy("turn", "number").drop("turn")


def by_arrival(frames: DataFrame, interval_secs: int = 600) -> DataFrame:
    """Frames with the start of the flush interval their arrival falls into, as ``gen_start``.

    Frames without an arrival time stay together under a null.
    """
    intervals = F.floor(F.unix_seconds("arrival_ts") / interval_secs)
    return frames.withColumn("gen_start", F.timestamp_seconds(intervals * interval_secs))


def extent(frames: DataFrame, *generation_columns: str) -> DataFrame:
    """Rows, first and last ``seq`` per generation, and the number the next record gets."""
    return frames.groupBy(*generation_columns).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        (F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("next_seq"),
    )
