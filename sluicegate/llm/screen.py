"""Rows that may have one of many ids, found without a shuffle.

A bitmap of hashed ids is made by Spark, read once and broadcast: ``BITS_AN_ID`` bits an id and ``MOST_BITS`` (16 MB) in all. No
row that has one of the ids is missed. Of the others about one in ``BITS_AN_ID`` passes too, more where there are too many
ids for the bitmap; so whoever needs the ids alone joins what passes with them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_AN_ID = 16
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27
BYTES_A_BUCKET = 4096  # of Spark's bitmap functions


def may_be_in(ids: DataFrame, name: str) -> Column:
    """Whether the value of column ``name`` (bigint, no nulls) may be among ``ids`` (one column; rows may repeat)."""
    (column,) = ids.columns
    bits = 1 << (min(max(BITS_AN_ID * ids.count(), LEAST_BITS), MOST_BITS) - 1).bit_length()
    # Places of Spark's bitmaps begin with 1.
    places = ids.select((F.pmod(F.xxhash64(column), F.lit(bits)) + 1).alias("place"))
    buckets = places.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for bucket, found in buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place"))).collect():
        start = (bucket - 1) * BYTES_A_BUCKET
        bitmap[start : start + BYTES_A_BUCKET] = np.frombuffer(found, np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def among(place: pa.Array) -> pa.Array:
        p = place.to_numpy()
        return pa.array((shared.value[p >> 3] >> (p & 7) & 1).astype(bool))

    return among(F.pmod(F.xxhash64(name), F.lit(bits)))


def without(table: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``table`` without the rows whose ``name`` is in ``gone`` (that column alone). Only rows that may be in it are shuffled."""
    may = may_be_in(gone, name)
    return table.where(~may).unionByName(table.where(may).join(gone, name, "left_anti"))
