import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluicegate.options import IngestOptions
from sluicegate.plans.fixtures import fields_of, record_frames, registration_frames, registration_json
from sluicegate.plans.flush import Store
from sluicegate.schemas import FRAMES
from sluicegate.session import local_rows
from sluicegate.operators.registry import table_schemas
from sluicegate.sinks.targets import FolderTarget, committed_rows
from sluicegate.sources.frames import stream_frames
from sluicegate.sinks.owner import RootTaken
from sluicegate.streaming.flush_loop import (
    FlushDisabled,
    FlushService,
    drain,
    final_flush,
    flush_now,
    jittered_interval,
    start,
)
from sluicegate.streaming.pending import open_generations, open_tables


def test_jitter():
    rng = random.Random(1)
    drawn = {jittered_interval(600, 120, rng) for _ in range(5000)}
    assert (min(drawn), max(drawn)) == (480, 720)
    assert jittered_interval(600, 0, rng) == 600
    assert {jittered_interval(10, 20, rng) for _ in range(200)} == {60}
    assert min(jittered_interval(100, 500, rng) for _ in range(200)) == 60


def _register(spark, names, events):
    return registration_frames(spark, [(-1, registration_json(n, ("n",), fields_of(events.schema))) for n in names])


def _stored(spark, target, options, name):
    store = Store(options.root)
    schema = next(s for s in table_schemas(store.registry(spark)) if s.table == name)
    return committed_rows(spark, target, schema, store.ledger.read(spark))


class Breaks(FolderTarget):
    """Fails chosen writes, before or after the files are written."""

    def __init__(self, root, failing, after):
        super().__init__(root)
        self.writes, self.failing, self.after = 0, failing, after

    def replace_generation(self, split, schema, gen):
        self.writes += 1
        if self.after:
            super().replace_generation(split, schema, gen)
        if self.writes in self.failing:
            raise OSError("storage went away")
        if not self.after:
            super().replace_generation(split, schema, gen)


@pytest.mark.parametrize("after", [False, True])
def test_restart_after_a_failed_table(spark, root, events, after):
    landed, names = f"{root}/landed", ["a", "b", "c"]
    _register(spark, names, events).coalesce(1).write.parquet(landed)
    for n in names:
        record_frames(events, n, "event_id").coalesce(1).write.mode("append").parquet(landed)
    options, target = IngestOptions(f"{root}/job", parallel_tables=1), Breaks(f"{root}/job", {2, 4}, after)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            drain(stream_frames(spark, landed), target, options)
    drain(stream_frames(spark, landed), target, options)
    for n in names:
        stored = _stored(spark, target, options, n)
        assert stored.exceptAll(events).isEmpty() and events.exceptAll(stored).isEmpty()
    # Every table was written once, plus one more time for each of the two failures.
    assert target.writes == 5


def test_micro_batches_and_final_flush(spark, root, events):
    landed = f"{root}/landed"
    _register(spark, ["a"], events).coalesce(1).write.parquet(landed)
    options = IngestOptions(f"{root}/job", enable_manual_flush=True, max_files_per_trigger=2)
    target = FolderTarget(options.root)

    def stream():
        return stream_frames(spark, landed, options.max_files_per_trigger)

    flush_now(stream(), target, options)
    record_frames(events, "a", "event_id").repartition(5).write.mode("append").parquet(landed)
    flush_now(stream(), target, options)
    assert _stored(spark, target, options, "a").count() == events.count()
    assert Store(options.root).ledger.read(spark).count() == 3

    query = start(stream(), target, options)
    late = events.withColumn("event_id", F.col("event_id") + 10_000)
    record_frames(late, "a", "event_id").coalesce(1).write.mode("append").parquet(landed)
    final_flush(query, stream(), target, options)
    assert not query.isActive
    stored = _stored(spark, target, options, "a")
    both = events.unionByName(late)
    assert stored.exceptAll(both).isEmpty() and both.exceptAll(stored).isEmpty()


def test_manual_flush_has_to_be_enabled(spark, root):
    with pytest.raises(FlushDisabled, match="manual flush is disabled on this server"):
        flush_now(None, FolderTarget(root), IngestOptions(root))


class Slow(FolderTarget):
    def replace_generation(self, split, schema, gen):
        time.sleep(20)
        super().replace_generation(split, schema, gen)


def test_an_unfinished_drain_raises(spark, root, events):
    landed = f"{root}/landed"
    _register(spark, ["a"], events).coalesce(1).write.parquet(landed)
    record_frames(events, "a", "event_id").coalesce(1).write.mode("append").parquet(landed)
    options = IngestOptions(f"{root}/job")
    with pytest.raises(TimeoutError, match="not finished within 3 seconds"):
        drain(stream_frames(spark, landed), Slow(options.root), options, timeout_secs=3)
    assert Store(options.root).ledger.read(spark).isEmpty()
    drain(stream_frames(spark, landed), FolderTarget(options.root), options)
    assert _stored(spark, FolderTarget(options.root), options, "a").count() == events.count()


def _ask(spark, folder, seq):
    local_rows(spark, [(seq, None, b"\x03")], FRAMES).coalesce(1).write.mode("append").parquet(folder)


def _until(done, secs=60):
    end = time.monotonic() + secs
    while not done():
        assert time.monotonic() < end
        time.sleep(0.2)


@pytest.mark.parametrize("enabled", [True, False])
def test_a_flush_frame_wakes_the_flush_where_that_is_enabled(spark, root, events, enabled):
    landed, asked = f"{root}/landed", f"{root}/asked"
    _register(spark, ["a"], events).coalesce(1).write.parquet(landed)
    _ask(spark, asked, 1)
    options = IngestOptions(f"{root}/job", flush_interval_secs=36_000, flush_jitter_secs=0, enable_manual_flush=enabled)
    target = FolderTarget(options.root)
    service = FlushService(lambda: stream_frames(spark, landed), target, options, lambda: stream_frames(spark, asked))
    service.start()
    _until(lambda: service.flushes == int(enabled) and service.periodic.recentProgress)
    assert (service.control is not None) == enabled
    record_frames(events, "a", "event_id").coalesce(1).write.mode("append").parquet(landed)
    if enabled:
        _ask(spark, asked, 2)
        _until(lambda: service.flushes == 2)
        assert _stored(spark, target, options, "a").count() == events.count()
    else:
        assert Store(options.root).ledger.read(spark).isEmpty()
    service.stop()
    assert not service.periodic.isActive and _stored(spark, target, options, "a").count() == events.count()


def test_open_tables_of_a_job(spark, root, events):
    landed, names = f"{root}/landed", ["a", "b"]
    options, target = IngestOptions(f"{root}/job", parallel_tables=1), Breaks(f"{root}/job", {1, 2}, False)
    assert open_tables(spark, options.root).isEmpty() and open_generations(spark, options.root).isEmpty()
    _register(spark, names, events).coalesce(1).write.parquet(landed)
    for n, part in (("a", events), ("b", events.limit(3)), ("never", events.limit(2))):
        record_frames(part, n, "event_id").coalesce(1).write.mode("append").parquet(landed)
    with pytest.raises(StreamingQueryException):
        drain(stream_frames(spark, landed), target, options)
    found = sorted(map(tuple, open_tables(spark, options.root).collect()))
    assert found == [(0, "a", events.count()), (0, "b", 3)]
    drain(stream_frames(spark, landed), target, options)
    assert open_tables(spark, options.root).isEmpty() and open_generations(spark, options.root).isEmpty()


def test_a_second_job_is_refused(spark, root, events):
    landed = f"{root}/landed"
    _register(spark, ["a"], events).coalesce(1).write.parquet(landed)
    mine, other = (IngestOptions(f"{root}/job", owner=name) for name in ("mine", "other"))
    query = start(stream_frames(spark, landed), FolderTarget(mine.root), mine)
    with pytest.raises(RootTaken):
        drain(stream_frames(spark, landed), FolderTarget(other.root), other)
    final_flush(query, stream_frames(spark, landed), FolderTarget(mine.root), mine)
    drain(stream_frames(spark, landed), FolderTarget(other.root), other)
