"""Frame sources: stored frames, one stored generation, or a stream of frame files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FRAMES, GENERATIONS
from ..sinks.control import overwrite


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRAMES).parquet(path)


def read_generation(spark: SparkSession, path: str, gen: int, ordered: bool = False) -> DataFrame:
    """Frames of one generation; the partition filter keeps other generations unread."""
    frames = spark.read.schema(GENERATIONS).parquet(path).where(F.col("gen") == gen)
    frames = frames.select(*FRAMES.names)
    return frames.orderBy("seq") if ordered else frames


def stream_frames(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Frame files as a stream; the limits bound one micro-batch (Spark takes one or the other)."""
    reader = spark.readStream.schema(FRAMES)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def as_frames(source: DataFrame, frame: Column, seq: Column | None, arrival_ts: Column | None) -> DataFrame:
    """Any source with a binary column, batch or stream, as frames.

    Without ``seq`` there is no order to admit by; pass ``by_order=False`` when admitting then.
    """
    null_of = lambda kind: F.lit(None).cast(kind)
    return source.select(
        (null_of("bigint") if seq is None else seq.cast("bigint")).alias("seq"),
        (null_of("timestamp") if arrival_ts is None else arrival_ts.cast("timestamp")).alias("arrival_ts"),
        frame.cast("binary").alias("frame"),
    )


def write_frames(frames: DataFrame, path: str, gen: int) -> None:
    """Store frames as one generation, replacing what an earlier attempt left."""
    overwrite(frames.select(*FRAMES.names), f"{path.rstrip('/')}/gen={gen}")
