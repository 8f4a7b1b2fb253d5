"""Flush one generation of frames into typed tables, exactly once per table.

The frames are read once and staged in the shared folder, split by class and by a hash of the table
name, and sorted by table inside. Every later step reads only its own staged folders, and Parquet's
statistics skip other tables' pages in them, so the work over all tables is about one more pass, and a lost
executor costs a re-read of staged files rather than of the source. A generation has a staged folder of its
own, which goes once the ledger row is written.

Steps: stage, store registrations and warnings, write tables, count them in one job, write rejects, write the
ledger. One more table is one more write. The ledger row is what makes a table's generation visible; a failed
table raises after the others are done.

Control rows of closed generations are put together every ``EVERY`` generations (``sinks/control.py``), so a
flush lists and merges as much in its ten-thousandth generation as in its twentieth. A generation up to the last
round is closed: running it again reports it and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import BoundedSemaphore

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import BAD_REGISTRATION, FLUSH, RECORD, REGISTER, decode, unknown_table
from ..operators.lookup import lookup
from ..operators.registry import (
    TableSchema,
    merged,
    registrations,
    registry,
    resolved_fields,
    table_schema,
)
from ..operators.typing import rejected_rows
from ..options import IngestOptions
from ..schemas import LEDGER, PLACES, REGISTRY_PARTS, REJECTS, STAGED, STORED_REJECTS, WARNINGS
from ..session import local_rows
from ..sinks import control
from ..sinks.control import BEFORE_ALL, ControlTable, numbered_folders, overwrite, read_or_empty, remove
from ..sinks.targets import FolderTarget, NameTaken, Target, layout, path_part
from ..sinks.views import publish, ready_for_views

REGISTRATION_CLASS = "registration"
RECORD_CLASS = "record"
FLUSH_CLASS = "flush"
REJECT_CLASS = "reject"
# Odd names cannot flood the folder, whatever arrives; a bucket with many tables costs page headers only.
BUCKETS = 256


class StaleGeneration(ValueError):
    """A new generation with a number among those that are closed; readers would see it before it is whole."""


class FlushFailed(RuntimeError):
    """Some tables of a generation were not committed; a replay does those and skips the rest."""


@dataclass
class FlushReport:
    gen: int
    rows: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    already_committed: tuple[str, ...] = ()
    # What the staging job observed on its way, for reporting only: a repeated task counts again.
    observed: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class _Work:
    schema: TableSchema
    bucket: int
    first_seq: int | None
    has_early: bool
    known: dict[str, str]
    owner: str
    folded: str
    staged: int


def _newest_layouts(places: DataFrame) -> DataFrame:
    """Each place of each table once, by the generation that made it."""
    first = places.groupBy("table", "folded", "place").agg(F.min("gen").alias("gen"), F.min_by("layout", "gen").alias("layout"))
    return first.select(*PLACES.names)


def _rows_per_table(ledger: DataFrame) -> DataFrame:
    """Committed rows of each table over closed generations."""
    whole = ledger.groupBy("table").agg(F.max("gen").alias("gen"), F.sum("rows").alias("rows"), F.bool_and("committed").alias("committed"))
    return whole.select(*LEDGER.names)


class Store:
    """Paths and control tables under the job's root folder."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        merged_parts = lambda parts: merged(parts).withColumn("gen", F.lit(None).cast("bigint")).select(*REGISTRY_PARTS.names)
        self.registry_parts = ControlTable(f"{self.root}/control/registry", REGISTRY_PARTS, merged_parts)
        self.places = ControlTable(f"{self.root}/control/places", PLACES, _newest_layouts)
        self.ledger = ControlTable(f"{self.root}/control/ledger", LEDGER, _rows_per_table)
        self.warnings = ControlTable(f"{self.root}/control/warnings", WARNINGS, lambda rows: rows)
        self.rejects = f"{self.root}/rejects"

    def staged(self, gen: int) -> str:
        return f"{self.root}/staged/{gen}"

    def registry(self, spark: SparkSession, gen: int | None = None) -> DataFrame:
        """The registry as of ``gen``, or as of now. Later registrations never change a replay."""
        return self.registry_parts.as_of(spark, gen).drop("gen")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.rejects, STORED_REJECTS).drop("part")

    def closed_upto(self, spark: SparkSession) -> int | None:
        """All generations up to this one are closed, and what tables hold of them is committed."""
        return self.ledger.merged_upto(spark)

    def put_together(self, spark: SparkSession, gen: int) -> bool:
        """Put control rows up to ``gen`` together if it is time and every generation up to it is closed."""
        closed = self.closed_upto(spark)
        recent = [g for g in self.ledger.recent_gens(spark) if (BEFORE_ALL if closed is None else closed) < g <= gen]
        if len(recent) < control.EVERY or any(g <= gen for g in numbered_folders(spark, f"{self.root}/staged")):
            return False
        rows = self.ledger._read_recent(spark, recent)
        if not rows.where("table IS NOT NULL AND NOT committed").isEmpty():
            return False
        # The ledger goes last, because its round is what says that a generation is closed.
        for control_table in (self.registry_parts, self.places, self.ledger):
            control_table.put_together(spark, gen)
        return True


def stage(frames: DataFrame, store: Store, options: IngestOptions, gen: int) -> dict[str, int]:
    """Decode the frames once and write them by class and table bucket; what was observed meanwhile."""
    decoded = decode(frames, options.enable_manual_flush, options.max_frame_bytes)
    kind, msg = F.col("kind"), F.col("msg")
    observation = Observation()
    decoded = decoded.observe(
        observation,
        F.count(F.lit(1)).alias("frames"),
        F.count_if(msg.isNull() & (kind == RECORD)).alias("records"),
        F.count_if(msg.isNull() & (kind == REGISTER)).alias("registrations"),
        F.count_if(msg.isNotNull()).alias("refused"),
        F.coalesce(F.sum(F.octet_length("frame")), F.lit(0)).alias("bytes"),
    )
    split = (
        F.when(msg.isNotNull(), REJECT_CLASS)
        .when(kind == RECORD, RECORD_CLASS)
        .when(kind == REGISTER, REGISTRATION_CLASS)
        .when(kind == FLUSH, FLUSH_CLASS)
    )
    # The raw frame is kept where the decoded columns do not hold all of it.
    keeps_frame = msg.isNotNull() | F.col("payload").isNull()
    staged = decoded.select(
        "seq",
        "arrival_ts",
        "kind",
        "table",
        "payload",
        F.when(keeps_frame, F.col("frame")).alias("frame"),
        "msg",
        split.alias("class"),
        F.coalesce(F.pmod(F.xxhash64("table"), F.lit(BUCKETS)).cast("int"), F.lit(0)).alias("bucket"),
    )
    # Many tables in every task would leave many tiny files. Rebalancing groups them and, unlike a hash
    # repartition, splits a bucket that is too large for one task.
    grouped = staged.hint("rebalance", F.col("class"), F.col("bucket")).sortWithinPartitions("class", "bucket", "table")
    overwrite(grouped, store.staged(gen), "class", "bucket")
    try:
        return dict(observation.get)
    except Py4JJavaError:
        # Where Spark proves before it runs that there are no rows, there is nothing to observe either.
        return {}


def _staged(spark: SparkSession, store: Store, gen: int, of_class: str, bucket: int | None = None) -> DataFrame:
    """One class, or one bucket of it, listed and read from its own folder only."""
    folder = f"{store.staged(gen)}/class={of_class}" + ("" if bucket is None else f"/bucket={bucket}")
    return read_or_empty(spark, folder, STAGED, base=store.staged(gen))


def _store_registrations(spark: SparkSession, store: Store, gen: int) -> None:
    """Keep this generation's part of the registry, one row per table, and a warning for each type it does not know."""
    parsed = registrations(_staged(spark, store, gen, REGISTRATION_CLASS))
    if parsed.isEmpty():
        return
    store.registry_parts.replace(registry(parsed), gen)
    unknown = resolved_fields(store.registry_parts.read_one(spark, gen)).where("unknown_type")
    if not unknown.isEmpty():
        store.warnings.replace(unknown, gen)


def _owned(named: DataFrame, places: DataFrame) -> DataFrame:
    """``named`` with the ``owner`` of its name, for names that a catalog folds to one.

    The table that was written there first keeps the place, whatever registers later. Where nothing was written yet
    it is the one that was registered first; replays see the same.
    """
    owners = places.groupBy("folded").agg(F.min_by("table", F.struct("gen", "table")).alias("kept"))
    first = named.groupBy("folded").agg(F.min_by("table", F.struct("first_seq", "table")).alias("first"))
    found = named.join(first, "folded").join(owners, "folded", "left")
    return found.withColumn("owner", F.coalesce("kept", "first")).drop("kept", "first")


def _work(spark: SparkSession, store: Store, target: Target, gen: int, by_order: bool) -> DataFrame:
    """One row per registered table with staged records, and one with a null table for all others."""
    counted = (
        _staged(spark, store, gen, RECORD_CLASS)
        .groupBy("table", "bucket")
        .agg(F.min("seq").alias("min_seq"), F.bool_or(F.col("seq").isNull()).alias("unordered"), F.count(F.lit(1)).alias("staged"))
    )
    # The same places for a replay, which may have recorded its own before it failed.
    places = store.places.as_of(spark, gen - 1)
    layouts = places.groupBy("table").agg(F.map_from_entries(F.collect_set(F.struct("place", "layout"))).alias("known"))
    known = store.registry(spark, gen).withColumn("folded", F.lower(F.to_json(F.struct("namespace", "table"))))
    owned = _owned(known, places) if target.folds_case(spark) else known.withColumn("owner", F.col("table"))
    named = owned.join(layouts, "table", "left")
    registered = F.col("fields").isNotNull()
    # A record without seq has no order to be admitted by.
    early = F.col("unordered") | F.coalesce(F.col("min_seq") <= F.col("first_seq"), F.lit(True)) if by_order else F.lit(False)
    kept = ("first_seq", "has_early", "namespace", "fields", "known", "owner", "folded")
    return (
        counted.join(named, "table", "left")
        .select(
            F.when(registered, F.col("table")).alias("table"),
            "bucket",
            "staged",
            F.when(registered, early).alias("has_early"),
            *[c for c in kept if c != "has_early"],
        )
        .groupBy("table")
        .agg(F.collect_set("bucket").alias("buckets"), F.sum("staged").alias("staged"), *[F.any_value(c).alias(c) for c in kept])
    )


def _records(spark: SparkSession, store: Store, gen: int, work: _Work, by_order: bool) -> DataFrame:
    rows = _staged(spark, store, gen, RECORD_CLASS, work.bucket).where(F.col("table") == work.schema.table)
    if by_order and work.has_early:
        rows = rows.where(F.col("seq") > work.first_seq)
    return rows


def _write_rejects(rows: DataFrame, store: Store, gen: int, part: str) -> None:
    overwrite(rows.select(*REJECTS.names), f"{store.rejects}/gen={gen}/part={part}")


def _flush_table(spark: SparkSession, store: Store, target: Target, options: IngestOptions, gen: int, work: _Work) -> bool:
    """Write one table's generation, in one job; whether its place is new."""
    if work.owner != work.schema.table:
        raise NameTaken(f"table '{work.schema.table}' has the place of table '{work.owner}'")
    is_new = target.ensure(spark, work.schema, work.known)
    records = _records(spark, store, gen, work, options.admit_by_order)
    target.replace_generation(target.prepared(records, work.schema, options.on_bad_row, options.ordered_files), work.schema, gen)
    return is_new


def _frame_rejects(spark: SparkSession, store: Store, gen: int) -> DataFrame:
    """Refused frames and broken registrations."""
    refused = _staged(spark, store, gen, REJECT_CLASS).select(
        "seq", "table", "payload", "frame", F.col("msg").alias("reason")
    )
    broken = (
        registrations(_staged(spark, store, gen, REGISTRATION_CLASS))
        .where(~F.col("ok"))
        .select("seq", "table", "payload", "frame", F.lit(BAD_REGISTRATION).alias("reason"))
    )
    return refused.unionByName(broken)


def _unadmitted(spark: SparkSession, store: Store, gen: int, by_order: bool, buckets: set[int]) -> DataFrame:
    """Records that came without or before a registration; only their tables' ``buckets`` are read."""
    first = store.registry(spark, gen).select("table", "first_seq")
    staged = _staged(spark, store, gen, RECORD_CLASS).where(F.col("bucket").isin(sorted(buckets)))
    rows = lookup(staged, first, "table", F.coalesce("seq", F.xxhash64("payload")))
    late = F.col("first_seq").isNull()
    if by_order:
        late = late | F.coalesce(F.col("first_seq") >= F.col("seq"), F.lit(True))
    return rows.where(late).select(
        "seq", "table", "payload", "frame", unknown_table(F.col("table")).alias("reason")
    )


def _work_item(row) -> _Work:
    known = dict(row["known"] or {})
    return _Work(table_schema(row), row["buckets"][0], row["first_seq"], row["has_early"], known, row["owner"], row["folded"], row["staged"])


def _in_parallel(options: IngestOptions, items, work: Callable) -> list[tuple]:
    """``(item, result, error)`` for each of ``items``, which are drawn a few at a time; no item waits for a slower one."""
    waiting = BoundedSemaphore(options.parallel_tables * 8)
    running: list[tuple[object, Future]] = []
    with ThreadPoolExecutor(options.parallel_tables) as pool:
        for item in items:
            waiting.acquire()
            future = pool.submit(work, item)
            future.add_done_callback(lambda _: waiting.release())
            running.append((item, future))
    # One table's failure must not stop the others.
    return [(item, None if future.exception() else future.result(), future.exception()) for item, future in running]


def _table_rejects(
    spark: SparkSession, store: Store, target: Target, options: IngestOptions, gen: int, written: Sequence[_Work], set_aside: dict[str, int], done: Sequence[TableSchema]
) -> list[TableSchema]:
    """Store what the tables set aside; the tables that keep a half to remove when the generation is closed."""
    if isinstance(target, FolderTarget):
        kept = [w.schema for w in written if set_aside[w.schema.table]] + [s for s in done if target.has_rejects(spark, s, gen)]
        if kept:
            _write_rejects(target.rejected(spark, kept, gen), store, gen, "tables")
        return kept

    def again(work: _Work) -> None:
        records = _records(spark, store, gen, work, options.admit_by_order)
        _write_rejects(rejected_rows(records, work.schema), store, gen, f"t-{path_part(work.schema.table)}")

    for _, _, error in _in_parallel(options, [w for w in written if set_aside[w.schema.table]], again):
        if error:
            raise error
    return []


def _report_closed(frames: DataFrame, spark: SparkSession, store: Store, gen: int) -> FlushReport:
    """The report of a generation that was closed long ago."""
    rows = {r["table"]: r["rows"] for r in store.ledger.read_one(spark, gen).toLocalIterator() if r["committed"]}
    if not rows and not decode(frames).where(F.col("kind") == RECORD).isEmpty():
        raise StaleGeneration(f"generation {gen} holds records, but all generations up to {store.closed_upto(spark)} are closed")
    rejected = store.rejected(spark).where(F.col("gen") == gen).count()
    return FlushReport(gen, rows, rejected, tuple(sorted(rows)))


def flush_generation(frames: DataFrame, gen: int, target: Target, options: IngestOptions) -> FlushReport:
    """Flush ``frames`` as generation ``gen``. Running it again with the same frames changes nothing."""
    spark = frames.sparkSession
    store = Store(options.root)
    by_order = options.admit_by_order
    closed = store.closed_upto(spark)
    if closed is not None and gen <= closed:
        return _report_closed(frames, spark, store, gen)
    observed = stage(frames, store, options, gen)
    _store_registrations(spark, store, gen)

    before = store.ledger.read_one(spark, gen).where("committed").select("table", "rows")
    done = {row["table"]: row["rows"] for row in before.toLocalIterator()}
    report = FlushReport(gen, already_committed=tuple(sorted(done)), observed=observed)
    report.rows.update(done)
    late_buckets, done_schemas = set(), []

    def to_do():
        for row in _work(spark, store, target, gen, by_order).toLocalIterator():
            if row["table"] is None or row["has_early"]:
                late_buckets.update(row["buckets"])
            if row["table"] in done:
                done_schemas.append(table_schema(row))
            elif row["table"] is not None:
                yield _work_item(row)

    results = _in_parallel(options, to_do(), lambda work: _flush_table(spark, store, target, options, gen, work))
    failures = [(work.schema.table, error) for work, _, error in results if error]
    written = [work for work, _, error in results if not error]
    new = [(gen, w.schema.table, w.folded, target.place(w.schema), layout(w.schema.struct_type())) for w, is_new, error in results if is_new and not error]

    # Counted from what was written, which stays true after task retries, when accumulators may not.
    counts = target.counts(spark, [w.schema for w in written], gen) if written else {}
    report.rows.update((w.schema.table, counts[w.schema.table][0]) for w in written)
    # Late records are staged too, so a table with some is read again even where nothing else is missing.
    set_aside = {w.schema.table: w.staged - counts[w.schema.table][0] for w in written}
    if isinstance(target, FolderTarget):
        set_aside = {t: n for t, (_, n) in counts.items()}
    if options.publish_views:
        # A view needs files to be planned over; it shows nothing before the ledger row is there.
        ready_for_views(spark, store.ledger)
        unpublished = _in_parallel(options, [w.schema for w in written if counts[w.schema.table][0]], lambda schema: publish(spark, target, schema, store.ledger))
        refused_views = {schema.table: error for schema, _, error in unpublished if error}
        failures += refused_views.items()
        report.rows = {t: n for t, n in report.rows.items() if t not in refused_views}
    halves = _table_rejects(spark, store, target, options, gen, written, set_aside, done_schemas)
    refused = _frame_rejects(spark, store, gen)
    if late_buckets:
        refused = refused.unionByName(_unadmitted(spark, store, gen, by_order, late_buckets))
    any_refused = bool(late_buckets) or not refused.isEmpty()
    if any_refused:
        _write_rejects(refused, store, gen, "frames")
    if any_refused or any(set_aside.values()) or done:
        report.rejected = read_or_empty(spark, f"{store.rejects}/gen={gen}", REJECTS).count()
    _close(spark, store, gen, report, new, failures)
    for schema in halves:
        target.finish(spark, schema, gen)
    remove(spark, store.staged(gen))
    store.put_together(spark, gen)
    return report


def _close(spark: SparkSession, store: Store, gen: int, report: FlushReport, new: list[tuple], failures: list) -> None:
    if new:
        earlier = store.places.read_one(spark, gen)
        kept = [tuple(r) for r in earlier.toLocalIterator() if r["place"] not in {n[3] for n in new}]
        store.places.replace(local_rows(spark, new + kept, PLACES), gen)
    flags = [(gen, table, rows, True) for table, rows in report.rows.items()]
    flags += [(gen, table, None, False) for table, _ in failures]
    if flags:
        store.ledger.replace(local_rows(spark, flags, LEDGER), gen)
    if failures:
        names = ", ".join(f"'{table}'" for table, _ in failures)
        raise FlushFailed(f"generation {gen}: not committed: {names}") from failures[0][1]
