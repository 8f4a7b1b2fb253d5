"""Counts over decoded records. All aggregate with a map-side partial, so one hot table costs nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decode import RECORD
from .typing import MALFORMED, with_reasons


def _how_many(condition: Column) -> Column:
    return F.count_if(condition)


def rows_per_table(admitted: DataFrame) -> DataFrame:
    """Accepted records per table."""
    accepted = admitted.where((F.col("kind") == RECORD) & F.col("msg").isNull())
    return accepted.groupBy("table").agg(F.count(F.lit(1)).alias("rows"))


def outcome_counts(outcome_rows: DataFrame, *by: str) -> DataFrame:
    """Frames per outcome; the default grouping is table, status and message."""
    return outcome_rows.groupBy(*(by or ("table", "status", "msg"))).agg(F.count(F.lit(1)).alias("n"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("table", "reason").agg(F.count(F.lit(1)).alias("n"))


def ingest_summary(admitted: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """Per table: frames received, admitted, malformed, bad and stored, in one pass over the frames."""
    records = admitted.where((F.col("kind") == RECORD) & F.col("table").isNotNull())
    judged = with_reasons(records, registry_rows)
    admitted_ok = F.col("msg").isNull()
    reason = F.col("reason")
    return judged.groupBy("table").agg(
        F.count(F.lit(1)).alias("received"),
        _how_many(admitted_ok).alias("admitted"),
        _how_many(admitted_ok & (reason == MALFORMED)).alias("malformed"),
        _how_many(admitted_ok & (reason != MALFORMED)).alias("bad"),
        _how_many(admitted_ok & F.col("registered") & reason.isNull()).alias("stored"),
    )
