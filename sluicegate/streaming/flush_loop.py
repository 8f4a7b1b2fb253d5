"""The flush loop: one micro-batch is one generation.

The checkpoint freezes each micro-batch's range of the source. A batch that fails is run again with the
same id and the same range when the query is started again, and a batch is closed only when all its
tables are committed, because ``flush_generation`` raises otherwise.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.binary import byte_hex
from ..operators.decode import FLUSH, FLUSH_DISABLED
from ..options import IngestOptions
from ..plans.flush import flush_generation
from ..sinks.owner import claim, release
from ..sinks.targets import Target

# Fixed value: the shortest flush interval.
MIN_INTERVAL_SECS = 60


class FlushDisabled(PermissionError):
    pass


def jittered_interval(interval_secs: int, jitter_secs: int, rng: random.Random | None = None) -> int:
    """Seconds between flushes, moved by up to the jitter either way, so that many jobs spread out."""
    shift = (rng or random.Random()).randint(0, 2 * jitter_secs)
    return max(MIN_INTERVAL_SECS, interval_secs + shift - jitter_secs)


def _writer(frames: DataFrame, target: Target, options: IngestOptions):
    claim(frames.sparkSession, options)

    def flush(batch: DataFrame, batch_id: int) -> None:
        flush_generation(batch, batch_id, target, options)

    checkpoint = f"{options.root.rstrip('/')}/checkpoint"
    return frames.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)


def start(frames: DataFrame, target: Target, options: IngestOptions) -> StreamingQuery:
    """Flush periodically until stopped. The interval is drawn once per start."""
    secs = jittered_interval(options.flush_interval_secs, options.flush_jitter_secs)
    return _writer(frames, target, options).trigger(processingTime=f"{secs} seconds").start()


def drain(frames: DataFrame, target: Target, options: IngestOptions, timeout_secs: int | None = None) -> None:
    """Flush everything there is, then stop. Replays a batch that an earlier run left open.

    Raises ``TimeoutError`` when that takes longer than ``timeout_secs``; what is unfinished stays open.
    """
    query = _writer(frames, target, options).trigger(availableNow=True).start()
    try:
        finished = query.awaitTermination(timeout_secs)
    finally:
        query.stop()
    if finished is False:
        raise TimeoutError(f"the flush was not finished within {timeout_secs} seconds")


def flush_now(frames: DataFrame, target: Target, options: IngestOptions) -> None:
    """A flush on demand, where the job allows it."""
    if not options.enable_manual_flush:
        raise FlushDisabled(FLUSH_DISABLED)
    drain(frames, target, options)


def final_flush(query: StreamingQuery, frames: DataFrame, target: Target, options: IngestOptions) -> None:
    """Stop a running query and flush what has arrived, without waiting for its next trigger.

    A flush cut short by the stop is replayed under its own id first.
    """
    query.stop()
    drain(frames, target, options)
    release(frames.sparkSession, options)


class FlushService:
    """A periodic flush, and a control stream on which a flush frame causes a flush at once.

    ``frames`` makes the stream of frames, since a stream that was stopped is started as a new one. The control
    stream reads ``control_frames``, by default the same frames; it takes in their first byte only, but a file
    source reads whole values for that, so a busy deployment lands flush frames in a folder of their own as well.
    One flush runs at a time. A flush frame that comes while manual flush is disabled causes nothing; the flush
    that takes it in sets it aside with its refusal.
    """

    def __init__(
        self,
        frames: Callable[[], DataFrame],
        target: Target,
        options: IngestOptions,
        control_frames: Callable[[], DataFrame] | None = None,
        poll_secs: int = 1,
    ):
        self.frames, self.target, self.options = frames, target, options
        self.control_frames, self.poll_secs = control_frames or frames, poll_secs
        self.flushes = 0
        self.periodic: StreamingQuery | None = None
        self.control: StreamingQuery | None = None
        self._one_at_a_time = RLock()

    def start(self) -> None:
        self.periodic = start(self.frames(), self.target, self.options)
        if not self.options.enable_manual_flush:
            return
        asked = self.control_frames().where(byte_hex(F.col("frame"), 1) == FLUSH)
        writer = asked.writeStream.foreachBatch(self._on_frames)
        checkpoint = f"{self.options.root.rstrip('/')}/control_checkpoint"
        self.control = writer.option("checkpointLocation", checkpoint).trigger(processingTime=f"{self.poll_secs} seconds").start()

    def _on_frames(self, batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            self.flush()

    def flush(self) -> None:
        """Flush all that has arrived, then go on with the periodic flush."""
        with self._one_at_a_time:
            self.periodic.stop()
            drain(self.frames(), self.target, self.options)
            self.flushes += 1
            self.periodic = start(self.frames(), self.target, self.options)

    def stop(self) -> None:
        """The last flush of a job that ends."""
        if self.control is not None:
            self.control.stop()
        with self._one_at_a_time:
            final_flush(self.periodic, self.frames(), self.target, self.options)
