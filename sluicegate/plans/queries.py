"""Queries over frames made from the given tables: one per operator of the ingest path.

Every row of a table becomes a frame. Where a query needs damaged or varied frames, a rule on the row's
id says what happens to that row, so that plain SQL over the original table gives the expected answer.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.binary import utf8_bytes
from ..functions.names import namespace_path
from ..functions.sql_text import quoted
from ..operators import decode as dec
from ..operators import generations as gens
from ..operators import reports
from ..operators.decode import admit, answers, decode, outcomes, records_of
from ..operators.registry import (
    Field,
    TableSchema,
    registrations,
    registry,
    resolved_fields,
    table_schemas,
    with_schema,
)
from ..operators.typing import NO_SCHEMA, REJECT, rejected_rows, split_rows, typed_rows
from ..options import IngestOptions
from ..session import cut_lineage, working_folder
from ..sinks.targets import (
    GENERATION,
    CatalogTarget,
    FolderTarget,
    append,
    committed_rows,
    ensure_namespace,
    ensure_table,
)
from ..sinks.views import publish, view_name
from ..sources.frames import as_frames, read_generation, stream_frames, write_frames
from ..streaming.flush_loop import FlushService, drain, final_flush, flush_now, start
from ..streaming.pending import open_tables
from .fixtures import (
    body_of,
    fields_of,
    frame_of,
    frames_from,
    payload_of,
    record_frames,
    registration_frames,
    registration_json,
)
from .flush import FlushFailed, Store, flush_generation

NAMESPACE = ("raw",)
BEFORE_ALL = -1

# Tables sent as one mixed input, with the column that numbers their frames.
MIXED = {"events": "event_id", "orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _registry_of(spark: SparkSession, messages: Sequence[tuple[int, str]]) -> DataFrame:
    """The registry that these messages make, kept so that its later uses do not parse them again."""
    return cut_lineage(spark, registry(registrations(decode(registration_frames(spark, messages)))))


def _message(name: str, fields: Sequence[Field], seq: int = BEFORE_ALL) -> tuple[int, str]:
    return seq, registration_json(name, NAMESPACE, fields)


def _schema(name: str, fields: Sequence[Field]) -> TableSchema:
    return TableSchema(name, NAMESPACE, tuple(fields))


def _decoded_table(spark: SparkSession, sf_dir: str, name: str, seq: str) -> DataFrame:
    """Send a table as frames and read it back typed, by the schema that was registered for it."""
    source = load(spark, sf_dir, name)
    known = _registry_of(spark, [_message(name, fields_of(source.schema))])
    admitted = admit(decode(record_frames(source, name, seq)), known)
    return typed_rows(records_of(admitted, name), next(table_schemas(known)))


def events_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_table(spark, sf_dir, "events", "event_id")


def lineitem_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_table(spark, sf_dir, "lineitem", "l_orderkey")


def documents_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_table(spark, sf_dir, "documents", "doc_id")


def _mixed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = None
    for name, seq in MIXED.items():
        part = record_frames(load(spark, sf_dir, name), name, seq)
        frames = part if frames is None else frames.unionByName(part)
    return frames


def _messages_of(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> list[tuple[int, str]]:
    return [_message(name, fields_of(load(spark, sf_dir, name).schema)) for name in names]


def rows_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _registry_of(spark, _messages_of(spark, sf_dir, list(MIXED)))
    return reports.rows_per_table(admit(decode(_mixed_frames(spark, sf_dir)), known))


def _events_frames(source: DataFrame, frame: Column) -> DataFrame:
    return frames_from(source, F.col("event_id"), F.col("ts"), frame)


def _events_body(source: DataFrame) -> Column:
    return body_of(F.lit("events"), payload_of(source))


def _kind_frames(source: DataFrame) -> DataFrame:
    """Message kinds by ``event_id % 5``; every other registration is cut short."""
    choice = F.col("event_id") % 5
    _, text = _message("events", fields_of(source.schema))
    broken = F.when(F.col("event_id") % 10 == 0, F.lit(text)).otherwise(F.lit(text[:-1]))
    frame = (
        F.when(choice == 0, frame_of(dec.REGISTER, utf8_bytes(broken)))
        .when(choice == 1, frame_of(dec.RECORD, _events_body(source)))
        .when(choice == 2, frame_of(dec.FLUSH, utf8_bytes(F.lit(""))))
        .when(choice == 3, frame_of("00", _events_body(source)))
        .otherwise(frame_of("7F", _events_body(source)))
    )
    return _events_frames(source, frame)


def _kind_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(_kind_frames(load(spark, sf_dir, "events")))
    # The registry comes out of the same frames; it is kept so that they are scanned for it only once.
    known = cut_lineage(spark, registry(registrations(decoded)))
    return outcomes(admit(decoded, known))


def message_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.outcome_counts(_kind_outcomes(spark, sf_dir), "kind", "status")


def answers_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(_kind_outcomes(spark, sf_dir))


def header_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    choice = F.col("event_id") % 10
    payload = utf8_bytes(payload_of(source))
    raw = lambda text: F.unhex(F.lit(text))
    body = (
        F.when(choice == 0, raw("00"))
        .when(choice == 1, F.concat(raw("FFFF"), utf8_bytes(F.lit("events"))))
        .when(choice == 2, F.concat(raw("0002FFFE"), payload))
        .when(choice == 3, F.concat(raw("0000"), payload))
        .otherwise(_events_body(source))
    )
    frame = F.when(choice == 4, raw("")).otherwise(frame_of(dec.RECORD, body))
    known = _registry_of(spark, [_message("events", fields_of(source.schema))])
    found = outcomes(admit(decode(_events_frames(source, frame)), known))
    return reports.outcome_counts(found, "status", "msg")


# One column per accepted spelling, plus one that is no type name: (column, spelling, SQL over events).
SPELLED = [
    ("c_string", "string", "event_type"),
    ("c_long", "long", "event_id"),
    ("c_int64", "int64", "user_id"),
    ("c_int", "int", "CAST(event_id AS INT)"),
    ("c_int32", "int32", "CAST(user_id AS INT)"),
    ("c_double", "double", "value"),
    ("c_float64", "float64", "value * 3"),
    ("c_float", "float", "CAST(value AS FLOAT)"),
    ("c_float32", "float32", "CAST(value * 3 AS FLOAT)"),
    ("c_boolean", "boolean", "event_id % 2 = 0"),
    ("c_timestamptz", "timestamptz", "ts"),
    ("c_timestamp", "timestamp", "ts"),
    ("c_date", "date", "CAST(ts AS DATE)"),
    ("c_binary", "binary", "event_type"),
    ("c_bytes", "bytes", "props"),
    ("c_uuid", "uuid", "event_type"),
]


def all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    as_sent = {
        "timestamptz": lambda c: F.concat(c.cast("timestamp_ntz").cast("string"), F.lit("Z")),
        "binary": lambda c: c.cast("binary"),
        "bytes": lambda c: c.cast("binary"),
    }
    columns = []
    for name, spelling, text in SPELLED:
        columns.append(as_sent.get(spelling, lambda c: c)(F.expr(text)).alias(name))
    source = events.select("event_id", *columns)
    payload = payload_of(source, leave_out=["event_id"])
    fields = [Field(name, spelling) for name, spelling, _ in SPELLED]
    known = _registry_of(spark, [_message("typed", fields)])
    admitted = admit(decode(record_frames(source, "typed", "event_id", payload=payload)), known)
    rows = typed_rows(records_of(admitted, "typed"), next(table_schemas(known)))
    # Instants as micros and bytes as hex, so that any SQL engine shows the same values.
    shown = {
        T.TimestampType: lambda c: F.unix_micros(c),
        T.BinaryType: lambda c: F.hex(c),
        T.DateType: lambda c: c.cast("string"),
        T.FloatType: lambda c: c.cast("double"),
    }
    return rows.select(
        *[shown.get(type(f.dataType), lambda c: c)(F.col(f.name)).alias(f.name) for f in rows.schema.fields]
    )


def _events_typed(spark: SparkSession, source: DataFrame, payload: Column, fields: Sequence[Field]):
    """Accepted ``events`` records with the given payload, and the schema they are typed by."""
    known = _registry_of(spark, [_message("events", fields)])
    frames = _events_frames(source, frame_of(dec.RECORD, body_of(F.lit("events"), payload)))
    return records_of(admit(decode(frames), known), "events"), next(table_schemas(known))


def missing_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    fields = [Field(f.name, f.type, f.name != "value") for f in fields_of(source.schema)]
    payload = F.when(F.col("event_id") % 3 == 0, payload_of(source, leave_out=["value"])).otherwise(
        payload_of(source)
    )
    return typed_rows(*_events_typed(spark, source, payload, fields))


def undeclared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    fields = [f for f in fields_of(source.schema) if f.name != "props"]
    extra = source.withColumn("zzz", F.lit(1))
    return typed_rows(*_events_typed(spark, extra, payload_of(extra), fields))


def malformed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    whole = payload_of(source)
    payload = F.when(F.col("event_id") % 7 == 0, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return typed_rows(*_events_typed(spark, source, payload, fields_of(source.schema)))


def missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    payload = F.when(F.col("event_id") % 4 == 0, payload_of(source, leave_out=["user_id"])).otherwise(
        payload_of(source)
    )
    rejects = rejected_rows(*_events_typed(spark, source, payload, fields_of(source.schema)))
    return reports.reject_counts(rejects)


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and set-aside records where one value has the wrong type."""
    source = load(spark, sf_dir, "events")
    user_id = F.when(F.col("event_id") % 6 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string"))
    payload = payload_of(source.withColumn("user_id", user_id))
    sent = source.select(F.col("event_id"), F.col("ts"), user_id.alias("user_id"), "event_type", "value", "props")
    records, schema = _events_typed(spark, sent, payload, fields_of(source.schema))
    outcome = F.coalesce(F.col(f"{REJECT}.reason"), F.lit("stored"))
    return split_rows(records, schema).groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


# Declared type of the second field of a registration, by supplier key modulo 8.
OFFERED = ["long", "int64", "double", "float32", "bytes", "timestamptz", "uuid", "Long"]


def _supplier_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier registers its nation's table; some leave ``required`` or the namespace out."""
    source = load(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    offered = F.element_at(F.array(*[F.lit(t) for t in OFFERED]), (key % 8 + 1).cast("int"))
    text = F.concat(
        F.lit('{"table":"nation_'),
        F.col("s_nationkey"),
        F.lit('","schema_id":'),
        key,
        F.when(key % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(',"namespace":["raw","n'), key % 3, F.lit('"]'))),
        F.lit(',"fields":[{"name":"id","type":"string"},{"name":"v","type":"'),
        offered,
        F.lit('","required":'),
        F.when(key % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit("}]}"),
    )
    return frames_from(source, key, F.lit(None), frame_of(dec.REGISTER, utf8_bytes(text)))


def latest_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = registry(registrations(decode(_supplier_registrations(spark, sf_dir))))
    return resolved_fields(known.drop("schema_id").withColumn("namespace", namespace_path(F.col("namespace"))))


def registration_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(_supplier_registrations(spark, sf_dir))
    known = cut_lineage(spark, registry(registrations(decoded)))
    return reports.outcome_counts(outcomes(admit(decoded, known)), "kind", "status", "msg")


def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _registry_of(spark, _messages_of(spark, sf_dir, ["events", "nation"]))
    return reports.outcome_counts(outcomes(admit(decode(_mixed_frames(spark, sf_dir)), known)))


def admission_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events")
    known = _registry_of(spark, [_message("events", fields_of(source.schema), seq=100)])
    admitted = admit(decode(record_frames(source, "events", "event_id")), known)
    return typed_rows(records_of(admitted, "events"), next(table_schemas(known)))


def _generation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name per order: numbered generations of changing length, and names that are none."""
    key = F.col("o_orderkey")
    name = (
        F.when(key == 0, F.lit("active"))
        .when(key % 5 == 1, F.lit("default"))
        .when(key % 5 == 2, F.concat(F.lit("frozen_"), key))
        .when(key % 5 == 3, F.concat(F.lit("active_x"), key))
        .otherwise(F.concat(F.lit("active_"), key * 7919))
    )
    return load(spark, sf_dir, "orders").select(name.alias("name"))


def generation_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gens.roles(_generation_names(spark, sf_dir))
    return rows.select("name", F.col("number").cast("bigint").alias("number"), "role")


def pending_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a generation and each of its orders a table commit, open orders uncommitted."""
    orders = load(spark, sf_dir, "orders")
    ledger = orders.select(
        F.col("o_custkey").alias("gen"),
        F.col("o_orderpriority").alias("table"),
        (F.col("o_orderstatus") != "O").alias("committed"),
    )
    seen = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gen"))
    left = gens.pending(seen, ledger).withColumn("number", F.col("gen"))
    last = seen.agg(F.max("gen")).scalar()
    orphans, frozen = left.where(F.col("gen") < last), left.where(F.col("gen") == last)
    return gens.work_list(orphans, frozen).select("gen")


def unregistered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by whether their table has a schema at flush time, and under which namespace."""
    known = _registry_of(spark, _messages_of(spark, sf_dir, ["events", "customer"]))
    records = decode(_mixed_frames(spark, sf_dir)).where(F.col("kind") == dec.RECORD)
    found = with_schema(records, known)
    reason = F.when(F.col("fields").isNull(), NO_SCHEMA)
    namespace = F.when(F.col("fields").isNotNull(), namespace_path(F.col("namespace")))
    return found.groupBy("table", namespace.alias("namespace"), reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def arrival_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = record_frames(load(spark, sf_dir, "events"), "events", "event_id", arrival="ts")
    rows = gens.extent(gens.by_arrival(frames, 600), "gen_start")
    return rows.select(F.unix_seconds("gen_start").alias("gen_start"), "rows", "first_seq", "last_seq", "next_seq")


def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: per table received, admitted, malformed, bad and stored, in one pass."""
    events = load(spark, sf_dir, "events")
    key = F.col("event_id")
    user_id = F.when(key % 6 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string"))
    whole = payload_of(events.withColumn("user_id", user_id))
    cut = F.when(key % 7 == 0, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    sent = events.withColumn("user_id", user_id)
    frames = record_frames(sent, "events", "event_id", payload=cut)
    for name, seq in MIXED.items():
        if name != "events":
            frames = frames.unionByName(record_frames(load(spark, sf_dir, name), name, seq))
    messages = _messages_of(spark, sf_dir, ["events", "orders"])
    messages.append(_message("customer", fields_of(load(spark, sf_dir, "customer").schema), seq=100))
    known = _registry_of(spark, messages)
    return reports.ingest_summary(admit(decode(frames), known), known)


def stored_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored generations; only the second is read, pruned by partition."""
    root = working_folder(spark, "generations")
    for gen, name in enumerate(("customer", "orders")):
        write_frames(record_frames(load(spark, sf_dir, name), name, MIXED[name]), root, gen)
    source = load(spark, sf_dir, "orders")
    records = decode(read_generation(spark, root, 1)).where(F.col("table") == "orders")
    return typed_rows(records, _schema("orders", fields_of(source.schema)), ordered=True)


def _land(spark: SparkSession, sf_dir: str, names: Sequence[str], folder: str) -> None:
    """Write registrations and then records as frame files that a stream picks up."""
    registration_frames(spark, _messages_of(spark, sf_dir, names)).coalesce(1).write.parquet(folder)
    for name in names:
        record_frames(load(spark, sf_dir, name), name, MIXED[name]).write.mode("append").parquet(folder)


def _options(root: str, **changes) -> IngestOptions:
    return IngestOptions(root=root, enable_manual_flush=True, **changes)


def _committed(spark: SparkSession, target, options: IngestOptions, name: str) -> DataFrame:
    store = Store(options.root)
    known = store.registry(spark).where(F.col("table") == name)
    return committed_rows(spark, target, next(table_schemas(known)), store.ledger.read(spark))


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame files through the stream into folders of Parquet, read back."""
    root = working_folder(spark, "streamed")
    _land(spark, sf_dir, ["events"], f"{root}/landed")
    options, target = _options(f"{root}/job", max_files_per_trigger=8), FolderTarget(f"{root}/job")
    flush_now(stream_frames(spark, f"{root}/landed", options.max_files_per_trigger), target, options)
    return _committed(spark, target, options, "events")


class FailsOnce(FolderTarget):
    """A target that breaks on the second table it is asked to write, the first time only."""

    MESSAGE = "storage went away"

    def __init__(self, root: str):
        super().__init__(root)
        self.writes = 0

    def replace_generation(self, split: DataFrame, schema: TableSchema, gen: int) -> None:
        self.writes += 1
        if self.writes == 2:
            raise OSError(self.MESSAGE)
        super().replace_generation(split, schema, gen)


def restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that fails between two tables of a generation and is started again: rows per table."""
    root = working_folder(spark, "restarted")
    names = list(MIXED)
    _land(spark, sf_dir, names, f"{root}/landed")
    options, target = _options(f"{root}/job", parallel_tables=1), FailsOnce(f"{root}/job")
    frames = stream_frames(spark, f"{root}/landed")
    try:
        drain(frames, target, options)
    except StreamingQueryException as failed:
        if FailsOnce.MESSAGE not in str(failed):
            raise
    else:
        raise AssertionError("the first run was to fail")
    drain(stream_frames(spark, f"{root}/landed"), target, options)
    counts = None
    for name in names:
        part = _committed(spark, target, options, name).select(F.lit(name).alias("table"))
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("table").agg(F.count(F.lit(1)).alias("rows"))


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespace and table made from the registration, one generation flushed, read back."""
    root = working_folder(spark, "catalog")
    name = "orders"
    source = load(spark, sf_dir, name)
    namespace = ("raw", root.rsplit("-", 1)[1])
    text = registration_json(name, namespace, fields_of(source.schema))
    frames = registration_frames(spark, [(BEFORE_ALL, text)]).unionByName(record_frames(source, name, MIXED[name]))
    options, target = _options(f"{root}/job"), CatalogTarget(f"{root}/job", location=f"{root}/warehouse")
    flush_generation(frames, 0, target, options)
    return _committed(spark, target, options, name)


def flushed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flush sets aside, by reason: refused frames, late records, malformed and bad payloads."""
    root = working_folder(spark, "rejects")
    source = load(spark, sf_dir, "events")
    key = F.col("event_id")
    user_id = F.when(key % 6 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string"))
    whole = payload_of(source.withColumn("user_id", user_id))
    cut = F.when(key % 7 == 0, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    named = F.when(key % 5 == 0, F.lit("unheard_of")).otherwise(F.lit("events"))
    frame = F.when(key % 11 == 0, frame_of("7F", utf8_bytes(F.lit("")))).otherwise(
        frame_of(dec.RECORD, body_of(named, cut))
    )
    sent = source.withColumn("user_id", user_id)
    message = _message("events", fields_of(source.schema), seq=100)
    frames = registration_frames(spark, [message]).unionByName(_events_frames(sent, frame))
    options = _options(f"{root}/job")
    flush_generation(frames, 0, FolderTarget(options.root), options)
    return reports.reject_counts(Store(options.root).rejected(spark))


def unordered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which every third has no ``seq`` and every seventh no arrival time: stored and refused per generation."""
    root = working_folder(spark, "unordered")
    source = load(spark, sf_dir, "events")
    key = F.col("event_id")
    frame = frame_of(dec.RECORD, _events_body(source))
    frames = frames_from(source, F.when(key % 3 != 0, key), F.when(key % 7 != 0, F.col("ts")), frame)
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    registered = registration_frames(spark, [_message("events", fields_of(source.schema))])
    flush_generation(registered.unionByName(frames), 0, target, options)
    stored = _committed(spark, target, options, "events").select(F.lit("stored").alias("outcome"))
    refused = Store(options.root).rejected(spark).select("reason")
    by_outcome = stored.unionByName(refused.withColumnRenamed("reason", "outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    arrived = gens.extent(gens.by_arrival(frames, 600), "gen_start")
    without = arrived.where(F.col("gen_start").isNull()).select(F.lit("no arrival time").alias("outcome"), F.col("rows").alias("n"))
    return by_outcome.unionByName(without)


def broken_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations whose bytes are no text are kept whole: rejects by the bytes they hold."""
    root = working_folder(spark, "broken")
    source = load(spark, sf_dir, "supplier")
    tail = F.concat(F.unhex(F.lit("FFFE")), utf8_bytes(F.col("s_name")))
    frames = frames_from(source, F.col("s_suppkey"), F.lit(None), frame_of(dec.REGISTER, tail))
    options = _options(f"{root}/job")
    flush_generation(frames, 0, FolderTarget(options.root), options)
    kept = Store(options.root).rejected(spark)
    return kept.select("seq", "reason", F.hex("frame").alias("bytes"))


def oversize_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frames under a limit of 2,000 bytes: outcomes by whether the frame fits."""
    source = load(spark, sf_dir, "documents")
    body = body_of(F.lit("documents"), F.col("text"))
    frames = frames_from(source, F.col("doc_id"), F.lit(None), frame_of(dec.RECORD, body))
    decoded = decode(frames, max_frame_bytes=2_000)
    return decoded.groupBy("kind", "msg").agg(F.count(F.lit(1)).alias("n"), F.count("payload").alias("with_payload"))


def stopped_by_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under the ``fail`` policy a bad value keeps its table's generation open and the others are committed."""
    root = working_folder(spark, "stopped")
    events, orders = load(spark, sf_dir, "events"), load(spark, sf_dir, "orders")
    user_id = F.when(F.col("event_id") % 6 == 0, F.lit("abc")).otherwise(F.col("user_id").cast("string"))
    sent = events.withColumn("user_id", user_id)
    frames = (
        registration_frames(spark, _messages_of(spark, sf_dir, ["events", "orders"]))
        .unionByName(record_frames(sent, "events", "event_id"))
        .unionByName(record_frames(orders, "orders", "o_orderkey"))
    )
    options = _options(f"{root}/job", on_bad_row="fail")
    try:
        flush_generation(frames, 0, FolderTarget(options.root), options)
    except FlushFailed as failed:
        if "'events'" not in str(failed):
            raise
    else:
        raise AssertionError("the bad rows were to stop the flush")
    return Store(options.root).ledger.read(spark).select("table", "rows", "committed")


def final_flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A periodic flush is started, more frames arrive, and a final flush takes in all there is."""
    root = working_folder(spark, "final")
    _land(spark, sf_dir, ["events"], f"{root}/landed")
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    query = start(stream_frames(spark, f"{root}/landed"), target, options)
    record_frames(load(spark, sf_dir, "events"), "events", "event_id").write.mode("append").parquet(f"{root}/landed")
    final_flush(query, stream_frames(spark, f"{root}/landed"), target, options)
    return _committed(spark, target, options, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


FILES_A_BATCH = 8


def bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of at most so many files: rows stored per generation, whatever the number of cores."""
    root = working_folder(spark, "bounded")
    registration_frames(spark, _messages_of(spark, sf_dir, ["orders"])).coalesce(1).write.parquet(f"{root}/landed")
    options, target = _options(f"{root}/job", max_files_per_trigger=FILES_A_BATCH), FolderTarget(f"{root}/job")

    def take_in() -> None:
        flush_now(stream_frames(spark, f"{root}/landed", options.max_files_per_trigger), target, options)

    take_in()
    for part in range(3):
        rows = load(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 == part)
        # As many files as one batch takes, so that its work is spread.
        record_frames(rows, "orders", "o_orderkey").repartition(FILES_A_BATCH).write.mode("append").parquet(f"{root}/landed")
        take_in()
    return Store(options.root).ledger.read(spark).select("gen", "table", "rows", "committed")


def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append: typed rows go twice into a catalog table."""
    root = working_folder(spark, "appended")
    schema = _schema("orders", fields_of(load(spark, sf_dir, "orders").schema))
    space = f"appended_{root.rsplit('-', 1)[1]}"
    ensure_namespace(spark, (space,), f"{root}/tables")
    name = quoted(space, schema.table)
    ensure_table(spark, name, schema)
    typed = _decoded_table(spark, sf_dir, "orders", MIXED["orders"]).withColumn(GENERATION, F.lit(0).cast("bigint"))
    append(typed, name)
    append(typed, name)
    return spark.table(name).drop(GENERATION)


def two_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second generation lacks a table of the first, in a session that overwrites only written partitions."""
    root = working_folder(spark, "generations")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    customer, nation = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    first = registration_frames(spark, _messages_of(spark, sf_dir, ["customer", "nation"]))
    first = first.unionByName(record_frames(customer.where("c_custkey % 2 = 0"), "customer", "c_custkey"))
    first = first.unionByName(record_frames(nation, "nation", "n_nationkey"))
    second = record_frames(customer.where("c_custkey % 2 = 1"), "customer", "c_custkey")
    spark.conf.set(mode, "dynamic")
    try:
        flush_generation(first, 0, target, options)
        flush_generation(second, 1, target, options)
    finally:
        spark.conf.set(mode, before)
    rows = [
        _committed(spark, target, options, name).select(F.lit(name).alias("table"), F.col(key).alias("key"))
        for name, key in (("customer", "c_custkey"), ("nation", "n_nationkey"))
    ]
    return rows[0].unionByName(rows[1].withColumn("key", F.col("key").cast(rows[0].schema["key"].dataType)))


class BreaksAfterWriting(CatalogTarget):
    """Writes the rows of one table's generation and then fails, as a job does that is cut off before its ledger row."""

    MESSAGE = "cut off after the write"

    def __init__(self, *args, table: str, gen: int, **kwargs):
        super().__init__(*args, **kwargs)
        self.table, self.gen = table, gen

    def replace_generation(self, rows: DataFrame, schema: TableSchema, gen: int) -> None:
        super().replace_generation(rows, schema, gen)
        if (schema.table, gen) == (self.table, self.gen):
            raise OSError(self.MESSAGE)


def _own_namespace(root: str) -> tuple[str, str]:
    """A namespace of the session catalog that no other run of a query uses."""
    return ("raw", root.rsplit("-", 1)[1])


def committed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views read through SQL after a generation in which one of two tables was written and not committed."""
    root = working_folder(spark, "views")
    namespace, keys = _own_namespace(root), {"events": "event_id", "orders": "o_orderkey"}
    options = _options(f"{root}/job", publish_views=True)
    target = BreaksAfterWriting(f"{root}/job", location=f"{root}/warehouse", table="events", gen=1)
    tables = {name: load(spark, sf_dir, name) for name in keys}
    texts = [(BEFORE_ALL, registration_json(name, namespace, fields_of(t.schema))) for name, t in tables.items()]

    def part(of_two: int) -> DataFrame:
        events, orders = [record_frames(t.where(F.col(keys[name]) % 2 == of_two), name, keys[name]) for name, t in tables.items()]
        return events.unionByName(orders)

    flush_generation(registration_frames(spark, texts).unionByName(part(0)), 0, target, options)
    try:
        flush_generation(part(1), 1, target, options)
    except FlushFailed as failed:
        if target.MESSAGE not in str(failed.__cause__):
            raise
    else:
        raise AssertionError("the second generation was to fail")
    events, orders = [view_name(TableSchema(name, namespace, ())) for name in keys]
    return spark.sql(f"SELECT 'events' AS `table`, event_id AS `key` FROM {events} UNION ALL SELECT 'orders', o_orderkey FROM {orders}")


def folder_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over a table of folders, read through SQL after two generations, the second flushed after it was made."""
    root = working_folder(spark, "folder-view")
    namespace, source = _own_namespace(root), load(spark, sf_dir, "events")
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    text = registration_json("events", namespace, fields_of(source.schema))
    schema = TableSchema("events", namespace, tuple(fields_of(source.schema)))
    halves = [record_frames(source.where(F.col("event_id") % 2 == part), "events", "event_id") for part in (0, 1)]
    flush_generation(registration_frames(spark, [(BEFORE_ALL, text)]).unionByName(halves[0]), 0, target, options)
    name = publish(spark, target, schema, Store(options.root).ledger, f"{root}/views")
    flush_generation(halves[1], 1, target, options)
    return spark.sql(f"SELECT * FROM {name}")


def open_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream has still to do after a planned failure: open generations, their tables and staged records."""
    root = working_folder(spark, "open")
    names = ["events", "orders", "customer"]
    _land(spark, sf_dir, names, f"{root}/landed")
    options = _options(f"{root}/job")
    target = BreaksAfterWriting(f"{root}/job", location=f"{root}/warehouse", table="orders", gen=0)
    target.namespace = lambda schema: ("__".join(_own_namespace(root)),)
    try:
        drain(stream_frames(spark, f"{root}/landed"), target, options)
    except StreamingQueryException as failed:
        if target.MESSAGE not in str(failed):
            raise
    else:
        raise AssertionError("the flush was to fail")
    return open_tables(spark, options.root)


def kept_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables whose names the catalog folds to one: the one written first keeps it, though the other has a lower ``seq``."""
    root = working_folder(spark, "names")
    source, namespace = load(spark, sf_dir, "orders"), _own_namespace(root)
    options, target = _options(f"{root}/job"), CatalogTarget(f"{root}/job", location=f"{root}/warehouse")
    for gen, (name, seq) in enumerate((("Orders", -1), ("orders", -2), ("Orders", None))):
        frames = record_frames(source.where(F.col("o_orderkey") % 3 == gen), name, "o_orderkey")
        if seq is not None:
            frames = frames.unionByName(registration_frames(spark, [(seq, registration_json(name, namespace, fields_of(source.schema)))]))
        try:
            flush_generation(frames, gen, target, options)
        except FlushFailed as failed:
            if gen != 1 or "has the place of table 'Orders'" not in str(failed.__cause__):
                raise
    stored = spark.table(quoted("__".join(namespace), "orders")).groupBy(F.col(GENERATION).alias("gen")).agg(F.count(F.lit(1)).alias("stored"))
    ledger = Store(options.root).ledger.read(spark)
    return ledger.join(stored, "gen", "left").select("gen", "table", "committed", F.coalesce("stored", F.lit(0)).alias("stored"))


def _first_batch(query: StreamingQuery, timeout_secs: int = 120) -> None:
    """Wait until a query has finished its first batch."""
    until = time.monotonic() + timeout_secs
    while query.isActive and not query.recentProgress:
        if time.monotonic() > until:
            raise TimeoutError("the first batch was not finished")
        time.sleep(0.1)


def flushed_by_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that a flush frame takes in: nothing but the frame causes the flush, hours before the next periodic one."""
    root = working_folder(spark, "asked")
    source, landed = load(spark, sf_dir, "events"), f"{root}/landed"
    registration_frames(spark, _messages_of(spark, sf_dir, ["events"])).coalesce(1).write.parquet(landed)
    options = _options(f"{root}/job", flush_interval_secs=36_000, flush_jitter_secs=0)
    target = FolderTarget(options.root)
    service = FlushService(lambda: stream_frames(spark, landed), target, options)
    service.start()
    try:
        _first_batch(service.periodic)
        record_frames(source, "events", "event_id").write.mode("append").parquet(landed)
        asks = source.agg((F.max("event_id") + 1).alias("seq"))
        frames_from(asks, F.col("seq"), F.lit(None), frame_of(dec.FLUSH, utf8_bytes(F.lit("")))).write.mode("append").parquet(landed)
        service.control.processAllAvailable()
        if service.flushes < 1:
            raise AssertionError("the flush frame was to cause a flush")
        return _committed(spark, target, options, "events")
    finally:
        service.stop()


def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flush notes of field types that it does not know and stores as text."""
    root = working_folder(spark, "warnings")
    options = _options(f"{root}/job")
    flush_generation(_supplier_registrations(spark, sf_dir), 0, FolderTarget(options.root), options)
    return Store(options.root).warnings.read(spark)


def empty_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations, the second of empty frames only, which writes nothing: the ledger of all."""
    root = working_folder(spark, "empty")
    source, events = load(spark, sf_dir, "orders"), load(spark, sf_dir, "events")
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    halves = [record_frames(source.where(F.col("o_orderkey") % 2 == part), "orders", "o_orderkey") for part in (0, 1)]
    registered = registration_frames(spark, _messages_of(spark, sf_dir, ["orders"]))
    empty = _events_frames(events, F.unhex(F.lit("")))
    for gen, frames in enumerate((registered.unionByName(halves[0]), empty, halves[1])):
        flush_generation(frames, gen, target, options)
    return Store(options.root).ledger.read(spark)


def streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of messages as a message bus gives them (``value``, ``offset``, ``timestamp``), flushed and read back."""
    root = working_folder(spark, "messages")
    landed = f"{root}/landed"
    registered = registration_frames(spark, _messages_of(spark, sf_dir, ["events"]))
    records = record_frames(load(spark, sf_dir, "events"), "events", "event_id", "ts")
    named = [F.col("frame").alias("value"), F.col("seq").alias("offset"), F.col("arrival_ts").alias("timestamp"), F.lit("frames").alias("topic")]
    registered.select(*named).coalesce(1).write.parquet(landed)
    records.select(*named).write.mode("append").parquet(landed)
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    messages = spark.readStream.schema("value binary, offset bigint, timestamp timestamp, topic string").parquet(landed)
    flush_now(as_frames(messages, F.col("value"), F.col("offset"), F.col("timestamp")), target, options)
    return _committed(spark, target, options, "events")


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a flush observed while it staged its frames, beside what its files hold."""
    root = working_folder(spark, "observed")
    source = load(spark, sf_dir, "events")
    key, payload = F.col("event_id"), payload_of(source)
    cut = F.when(key % 7 == 0, F.substr(payload, F.lit(1), F.length(payload) - 1)).otherwise(payload)
    frame = F.when(key % 11 == 0, frame_of("7F", utf8_bytes(F.lit("")))).otherwise(frame_of(dec.RECORD, body_of(F.lit("events"), cut)))
    registered = registration_frames(spark, [_message("events", fields_of(source.schema))])
    options, target = _options(f"{root}/job"), FolderTarget(f"{root}/job")
    report = flush_generation(registered.unionByName(_events_frames(source, frame)), 0, target, options)
    stored = _committed(spark, target, options, "events").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("stored"))
    set_aside = Store(options.root).rejected(spark).groupBy(F.when(F.col("table").isNull(), "refused").otherwise("set aside").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    held = stored.select("what", "n").unionByName(set_aside).groupBy().pivot("what", ["stored", "refused", "set aside"]).agg(F.sum("n"))
    seen = {name: F.lit(report.observed[name]).cast("bigint") for name in ("records", "refused", "registrations")}
    return held.select(
        seen["records"].alias("observed_records"),
        (F.col("stored") + F.col("set aside")).alias("counted_records"),
        seen["refused"].alias("observed_refused"),
        F.col("refused").alias("counted_refused"),
        seen["registrations"].alias("observed_registrations"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_events_typed": events_typed,
    "q02_lineitem_typed": lineitem_typed,
    "q03_documents_typed": documents_typed,
    "q04_rows_per_table": rows_per_table,
    "q05_message_kinds": message_kinds,
    "q06_header_damage": header_damage,
    "q07_all_types": all_types,
    "q08_missing_optional": missing_optional,
    "q09_undeclared_keys": undeclared_keys,
    "q10_malformed_payloads": malformed_payloads,
    "q11_missing_required": missing_required,
    "q12_bad_values": bad_values,
    "q13_latest_registrations": latest_registrations,
    "q14_admission": admission,
    "q15_admission_by_order": admission_by_order,
    "q16_generation_roles": generation_roles,
    "q17_pending_generations": pending_generations,
    "q18_unregistered": unregistered,
    "q19_arrival_generations": arrival_generations,
    "q20_ingest_summary": ingest_summary,
    "q21_streamed": streamed,
    "q22_restarted": restarted,
    "q23_catalog_table": catalog_table,
    "q24_answers": answers_json,
    "q25_registration_outcomes": registration_outcomes,
    "q26_stored_generation": stored_generation,
    "q27_flushed_rejects": flushed_rejects,
    "q28_unordered_records": unordered_records,
    "q29_broken_registrations": broken_registrations,
    "q30_oversize_frames": oversize_frames,
    "q31_stopped_by_bad_rows": stopped_by_bad_rows,
    "q32_final_flush": final_flushed,
    "q33_bounded_batches": bounded_batches,
    "q34_appended": appended,
    "q35_two_generations": two_generations,
    "q36_committed_view": committed_view,
    "q37_folder_view": folder_view,
    "q38_open_after_failure": open_after_failure,
    "q39_kept_names": kept_names,
    "q40_flushed_by_frame": flushed_by_frame,
    "q41_unknown_types": unknown_types,
    "q42_empty_generation": empty_generation,
    "q43_streamed_messages": streamed_messages,
    "q44_observed_counts": observed_counts,
}
