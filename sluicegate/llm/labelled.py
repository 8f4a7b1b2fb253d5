"""Labelled rows: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def learnable(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id`` and ``y`` (0 or 1), one row per id outside the fold ``held_out``.

    Rows without id or label are left out; of several labels of one id the highest counts.
    """
    usable = F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(F.col("doc_id"), folds) != held_out)
    return labels.where(usable).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))


def sample(docs: DataFrame, learn: DataFrame, rows: int) -> DataFrame:
    """``text`` and ``y`` of at most ``rows`` labelled rows, chosen by a hash of the id.

    The broadcast side has at most ``rows`` rows.
    """
    chosen = learn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows).select("doc_id", "text", "y")


def prior(learn: DataFrame) -> tuple[int, int]:
    """Labelled rows, and those with label 1."""
    n, ones = learn.agg(F.count(F.lit(1)), F.sum("y")).first()
    return n, ones or 0
