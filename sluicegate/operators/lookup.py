"""Left join against a table that is usually tiny but has no guaranteed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 128


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``small``; reading stops one row past the limit."""
    measured = small.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    )
    n, size = measured.first()
    return n <= max_rows and size <= max_bytes


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: str,
    spread_by: Column,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """``big`` joined to ``small``, which holds at most one row per key.

    A small side within the limits is broadcast and ``big`` is not shuffled. A larger one is joined on
    the key and a salt taken from ``spread_by``, so that a key with a third of all rows is still spread.
    """
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small.hint("merge"), [on, "_salt"], how).drop("_salt")
