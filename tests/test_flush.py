"""Flushing a generation: exactly once, whole rejects, several targets."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate.operators.registry import Field, table_schemas
from sluicegate.options import IngestOptions
from sluicegate.plans.fixtures import fields_of, record_frames, registration_frames, registration_json
from sluicegate.plans.flush import FlushFailed, Store, flush_generation, stage
from sluicegate.schemas import FRAMES
from sluicegate.session import local_rows
from sluicegate.sinks.targets import CatalogTarget, FolderTarget, NameTaken, SchemaChanged, committed_rows

A = (Field("x", "long"), Field("s", "string", False))


def _message(seq, table, fields=A, namespace=("n",)):
    return seq, registration_json(table, namespace, fields)


def _record(seq, table, payload):
    name = table.encode()
    return seq, None, b"\x02" + len(name).to_bytes(2, "big") + name + payload.encode()


def _frames(spark, messages, records):
    return registration_frames(spark, messages).unionByName(local_rows(spark, records, FRAMES))


def _stored(spark, target, options, table):
    store = Store(options.root)
    schema = next(s for s in table_schemas(store.registry(spark)) if s.table == table)
    return committed_rows(spark, target, schema, store.ledger.read(spark))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(params=["folder", "catalog"])
def target(request, root):
    if request.param == "folder":
        return FolderTarget(root)
    return CatalogTarget(root, location=f"{root}/warehouse")


def _namespace(root):
    return ("n", root.rsplit("-", 1)[1])


def test_replay_changes_nothing_and_rejects_are_whole(spark, root, target):
    options, namespace = IngestOptions(root), _namespace(root)
    frames = _frames(
        spark,
        [_message(10, "a", namespace=namespace), (11, "broken")],
        [
            _record(9, "a", '{"x":0}'),
            _record(12, "a", '{"x":1,"s":"one"}'),
            _record(13, "a", '{"x":2}'),
            _record(14, "a", '{"x":"no"}'),
            _record(15, "a", '{"s":"none"}'),
            _record(16, "a", '{"x":'),
            _record(17, "b", '{"x":1}'),
            (18, None, b"\x09zz"),
            (19, None, b"\x02\x00\x01a\xff"),
            (20, None, b""),
            (21, None, b"\x03"),
        ],
    )
    first = flush_generation(frames, 0, target, options)
    assert (first.rows, first.rejected, first.already_committed) == ({"a": 2}, 9, ())
    again = flush_generation(frames, 0, target, options)
    assert (again.rows, again.already_committed) == ({"a": 2}, ("a",))
    assert _rows(_stored(spark, target, options, "a")) == [(1, "one"), (2, None)]

    rejects = {r.seq: r for r in Store(root).rejected(spark).collect()}
    late = "unknown table '{}' — send REGISTER_SCHEMA first".format
    assert {seq: r.reason for seq, r in rejects.items()} == {
        9: late("a"),
        11: "invalid schema registration",
        14: "bad value for 'x'",
        15: "missing required field 'x'",
        16: "malformed payload",
        17: late("b"),
        18: "unknown message type 0x09",
        19: "malformed payload",
        21: "manual flush is disabled on this server",
    }
    assert rejects[14].payload == '{"x":"no"}' and rejects[17].payload == '{"x":1}'
    assert bytes(rejects[18].frame) == b"\x09zz" and bytes(rejects[19].frame) == b"\x02\x00\x01a\xff"


def test_generations_add_up_and_later_registrations_type_buffered_rows(spark, root, target):
    options, namespace = IngestOptions(root), _namespace(root)
    narrow = (Field("x", "int"), Field("s", "string", False))
    frames = _frames(
        spark,
        [_message(0, "a", narrow, namespace), _message(2, "a", A, namespace)],
        [_record(1, "a", '{"x":3000000000}')],
    )
    flush_generation(frames, 0, target, options)
    more = local_rows(spark, [_record(3, "a", '{"x":4}'), _record(4, "a", '{"x":5}')], FRAMES)
    flush_generation(more, 1, target, options)
    assert _rows(_stored(spark, target, options, "a")) == sorted([(4, None), (5, None), (3000000000, None)], key=repr)
    ledger = Store(root).ledger.read(spark)
    assert _rows(ledger) == [(0, "a", 1, True), (1, "a", 2, True)]


def test_a_replay_uses_the_registry_of_its_own_time(spark, root):
    options, target = IngestOptions(root), FolderTarget(root)
    frames = _frames(spark, [_message(0, "a")], [_record(1, "a", '{"x":1}')])
    flush_generation(frames, 0, target, options)
    changed = _frames(spark, [_message(5, "a", (Field("x", "string"),), ("elsewhere",))], [_record(6, "a", '{"x":"t"}')])
    flush_generation(changed, 1, target, options)
    before = _rows(target.stored(spark, next(table_schemas(Store(root).registry(spark, 0)))))
    Store(root).ledger.replace(Store(root).ledger.read_one(spark, 0).where("false"), 0)
    flush_generation(frames, 0, target, options)
    schema = next(table_schemas(Store(root).registry(spark, 0)))
    assert schema.namespace == ("n",) and _rows(target.stored(spark, schema)) == before == [(1, None, 0)]


def test_changed_schema_is_refused_and_the_others_are_committed(spark, root, target):
    options, namespace = IngestOptions(root), _namespace(root)
    start = _frames(
        spark,
        [_message(0, "a", namespace=namespace), _message(0, "b", namespace=namespace)],
        [_record(1, "a", '{"x":1}'), _record(1, "b", '{"x":1}')],
    )
    flush_generation(start, 0, target, options)
    wider = (*A, Field("more", "long", False))
    frames = _frames(
        spark,
        [_message(5, "a", wider, namespace)],
        [_record(6, "a", '{"x":2,"more":1}'), _record(6, "b", '{"x":2}')],
    )
    with pytest.raises(FlushFailed) as failed:
        flush_generation(frames, 1, target, options)
    assert isinstance(failed.value.__cause__, SchemaChanged)
    assert _rows(Store(root).ledger.read_one(spark, 1)) == [(1, "a", None, False), (1, "b", 1, True)]
    assert _rows(_stored(spark, target, options, "b")) == [(1, None), (2, None)]


def test_fail_policy_keeps_the_generation_open(spark, root):
    options, target = IngestOptions(root, on_bad_row="fail"), FolderTarget(root)
    frames = _frames(
        spark,
        [_message(0, "a"), _message(0, "b")],
        [_record(1, "a", '{"x":"no"}'), _record(2, "a", '{"x":1}'), _record(3, "b", '{"x":1}'), _record(4, "b", "{")],
    )
    with pytest.raises(FlushFailed):
        flush_generation(frames, 0, target, options)
    assert _rows(_stored(spark, target, options, "a")) == []
    assert _rows(_stored(spark, target, options, "b")) == [(1, None)]
    flush_generation(frames, 0, target, IngestOptions(root))
    assert _rows(_stored(spark, target, options, "a")) == [(1, None)]


def test_nothing_to_flush(spark, root):
    options, target = IngestOptions(root), FolderTarget(root)
    report = flush_generation(local_rows(spark, [], FRAMES), 0, target, options)
    assert (report.rows, report.rejected) == ({}, 0)
    assert Store(root).ledger.read(spark).isEmpty()
    registered = flush_generation(registration_frames(spark, [_message(0, "a")]), 1, target, options)
    assert registered.rows == {}


def test_a_table_whose_rows_are_all_set_aside(spark, root, target):
    options = IngestOptions(root)
    frames = _frames(spark, [_message(0, "a", namespace=_namespace(root))], [_record(1, "a", "{")])
    assert flush_generation(frames, 0, target, options).rows == {"a": 0}
    assert _rows(_stored(spark, target, options, "a")) == []


def test_names_cannot_leave_their_folder(spark, root):
    names = ["../up", "..", "a/b", "a.b", "_hidden", ".hid", "ü é", "a%2Fb", "p=q", "Case", "case", "{x}"]
    options, target = IngestOptions(root), FolderTarget(root)
    messages = [_message(0, n, namespace=("..", n)) for n in names]
    records = [_record(i + 1, n, f'{{"x":{i}}}') for i, n in enumerate(names)]
    report = flush_generation(_frames(spark, messages, records), 0, target, options)
    assert report.rows == {n: 1 for n in names}
    for i, n in enumerate(names):
        assert _rows(_stored(spark, target, options, n)) == [(i, None)]


def test_unusable_registrations_fail_their_table_only(spark, root):
    options, target = IngestOptions(root), FolderTarget(root)
    messages = [
        _message(0, "no_namespace", namespace=()),
        _message(0, "taken", (Field("_gen", "long"),)),
        _message(0, "no_fields", ()),
        _message(0, "good"),
    ]
    records = [_record(1, t, '{"x":1}') for t in ("no_namespace", "taken", "no_fields", "good")]
    with pytest.raises(FlushFailed) as failed:
        flush_generation(_frames(spark, messages, records), 0, target, options)
    assert all(f"'{t}'" in str(failed.value) for t in ("no_namespace", "taken", "no_fields"))
    assert _rows(_stored(spark, target, options, "good")) == [(1, None)]


def test_catalog_names(spark, root):
    target = CatalogTarget(root)
    schema = next(iter(table_schemas(_registry(spark, ("a", "b"), "we`ird"))))
    assert target.place(schema) == "`a__b`.`we``ird`"
    with pytest.raises(ValueError, match="__"):
        target.place(next(iter(table_schemas(_registry(spark, ("a__b",), "t")))))
    assert CatalogTarget(root, "lake").place(schema) == "`lake`.`a`.`b`.`we``ird`"


def _registry(spark, namespace, table):
    from sluicegate.operators.decode import decode
    from sluicegate.operators.registry import registrations, registry

    return registry(registrations(decode(registration_frames(spark, [_message(0, table, namespace=namespace)]))))


def test_many_tables_with_a_hot_one(spark, root, events):
    options = IngestOptions(root)
    target = FolderTarget(root)
    fields = tuple(fields_of(events.schema))
    names = [f"t{i}" for i in range(12)]
    flush_generation(registration_frames(spark, [_message(-1, n, fields) for n in names]), 0, target, options)
    # t0 gets every row, the others one row in eleven each.
    frames = record_frames(events, "t0", "event_id")
    for i, n in enumerate(names[1:]):
        frames = frames.unionByName(record_frames(events.where(F.col("event_id") % 11 == i), n, "event_id"))
    report = flush_generation(frames, 1, target, options)
    assert sum(report.rows.values()) == 2 * events.count() and report.rejected == 0
    hot = _stored(spark, target, options, "t0")
    assert hot.exceptAll(events).isEmpty() and events.exceptAll(hot).isEmpty()


def test_session_catalog_append(spark, root):
    from sluicegate.sinks.targets import append, ensure_namespace, ensure_table, quoted

    schema = next(iter(table_schemas(_registry(spark, ("n",), "plain"))))
    space = f"append_{root.rsplit('-', 1)[1]}"
    ensure_namespace(spark, (space,), f"{root}/it's here")
    name = quoted(space, "plain")
    assert ensure_table(spark, name, schema) and not ensure_table(spark, name, schema)
    rows = spark.createDataFrame([("a", 0, 1)], "s string, _gen bigint, x bigint")
    append(rows, name)
    append(rows, name)
    assert _rows(spark.table(name)) == [(1, "a", 0)] * 2


def test_options():
    env = {"FLUSH_INTERVAL_SECS": "30", "ENABLE_MANUAL_FLUSH": "TRUE"}
    options = IngestOptions.from_env("r", env, on_bad_row="fail")
    assert (options.flush_interval_secs, options.flush_jitter_secs) == (30, 120)
    assert options.enable_manual_flush and options.on_bad_row == "fail"
    with pytest.raises(ValueError, match="FLUSH_JITTER_SECS must be a number"):
        IngestOptions.from_env("r", {"FLUSH_JITTER_SECS": "soon"})
    for wrong in ({"on_bad_row": "skip"}, {"flush_interval_secs": -1}, {"parallel_tables": 0}):
        with pytest.raises(ValueError):
            IngestOptions("r", **wrong)


@pytest.fixture(params=["static", "dynamic"])
def overwrite_mode(request, spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", request.param)
    yield request.param
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_a_generation_without_a_table_of_the_last_one(spark, root, target, overwrite_mode):
    options, namespace = IngestOptions(root), _namespace(root)
    frames = _frames(
        spark,
        [_message(0, t, namespace=namespace) for t in "ab"],
        [_record(1, "a", '{"x":1}'), _record(2, "b", '{"x":2}')],
    )
    flush_generation(frames, 0, target, options)
    flush_generation(local_rows(spark, [_record(3, "b", '{"x":3}')], FRAMES), 1, target, options)
    flush_generation(frames, 0, target, options)
    assert _rows(_stored(spark, target, options, "a")) == [(1, None)]
    assert _rows(_stored(spark, target, options, "b")) == [(2, None), (3, None)]


def test_staged_rows_go_when_the_generation_is_closed(spark, root, target):
    options = IngestOptions(root)
    frames = _frames(spark, [_message(0, "a", namespace=_namespace(root))], [_record(1, "a", '{"x":1}')])
    flush_generation(frames, 0, target, options)
    for folder in ("staged/0", "separated/0/n.a"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            spark.read.parquet(f"{root}/{folder}")


def test_names_that_a_catalog_folds(spark, root, target):
    options, namespace = IngestOptions(root), _namespace(root)
    frames = _frames(
        spark,
        [_message(0, "Case", namespace=namespace), _message(1, "case", namespace=namespace)],
        [_record(2, "Case", '{"x":1}'), _record(3, "case", '{"x":2}')],
    )
    if isinstance(target, FolderTarget):
        assert flush_generation(frames, 0, target, options).rows == {"Case": 1, "case": 1}
        assert _rows(_stored(spark, target, options, "case")) == [(2, None)]
        return
    with pytest.raises(FlushFailed) as failed:
        flush_generation(frames, 0, target, options)
    assert isinstance(failed.value.__cause__, NameTaken) and "'case'" in str(failed.value)
    assert _rows(_stored(spark, target, options, "Case")) == [(1, None)]


def test_namespaces_that_would_join_to_one_name(spark, root):
    schemas = [next(iter(table_schemas(_registry(spark, n, "t")))) for n in (("a_", "b"), ("a", "_b"))]
    for schema in schemas:
        with pytest.raises(ValueError, match="begins or ends"):
            CatalogTarget(root).place(schema)
        assert CatalogTarget(root, "lake").place(schema).startswith("`lake`")


def test_records_without_seq_are_refused_once(spark, root, target):
    options = IngestOptions(root)
    records = [_record(5, "a", '{"x":5}'), _record(None, "a", '{"x":6}'), _record(None, "b", '{"x":7}')]
    report = flush_generation(_frames(spark, [_message(0, "a", namespace=_namespace(root))], records), 0, target, options)
    assert (report.rows, report.rejected) == ({"a": 1}, 2)
    assert _rows(_stored(spark, target, options, "a")) == [(5, None)]
    unordered = IngestOptions(f"{root}/unordered", admit_by_order=False)
    messages = [_message(0, "c", namespace=_namespace(root))]
    assert flush_generation(_frames(spark, messages, [_record(None, "c", '{"x":6}')]), 0, target, unordered).rows == {"c": 1}


def test_a_registration_that_is_not_text_is_kept_whole(spark, root):
    frames = local_rows(spark, [(1, None, b"\x01\xff\xfe\xfd")], FRAMES)
    flush_generation(frames, 0, FolderTarget(root), IngestOptions(root))
    (kept,) = Store(root).rejected(spark).collect()
    assert bytes(kept.frame) == b"\x01\xff\xfe\xfd" and kept.reason == "invalid schema registration"


def test_many_tables_in_a_first_generation(spark, root):
    options, target = IngestOptions(root, parallel_tables=8), FolderTarget(root)
    names = [f"t{i}" for i in range(60)]
    frames = _frames(spark, [_message(0, n) for n in names], [_record(1, n, f'{{"x":{i}}}') for i, n in enumerate(names)])
    stage(frames, Store(root), options, 0)
    staged = spark.read.parquet(Store(root).staged(0)).where("class = 'record'")
    assert staged.select("table").distinct().count() == 60 and staged.select("bucket").distinct().count() > 40
    assert flush_generation(frames, 0, target, options).rows == {n: 1 for n in names}
