import json

from pyspark.sql import functions as F

from sluicegate.operators.decode import BAD_REGISTRATION, admit, decode, outcomes
from sluicegate.operators.registry import Field, registrations, registry, table_schemas
from sluicegate.plans.fixtures import registration_frames

WHOLE = {"table": "t", "schema_id": 3, "namespace": ["a", "b"], "fields": [{"name": "x", "type": "long"}]}


def _changed(**parts):
    return json.dumps({k: v for k, v in {**WHOLE, **parts}.items() if v != "absent"})


GOOD = [
    json.dumps(WHOLE),
    _changed(schema_id="absent"),
    _changed(schema_id=None),
    _changed(namespace=[]),
    _changed(fields=[]),
    _changed(extra={"k": 1}),
    _changed(fields=[{"name": "x", "type": "uuid", "required": False, "doc": "ignored"}]),
]
BAD = [
    json.dumps(WHOLE)[:-1],
    json.dumps(WHOLE) + " junk",
    json.dumps(WHOLE) + "," + json.dumps(WHOLE),
    "",
    "[]",
    "5",
    "null",
    _changed(table="absent"),
    _changed(table=5),
    _changed(table=None),
    _changed(namespace="absent"),
    _changed(namespace="a"),
    _changed(namespace=["a", 1]),
    _changed(namespace=["a", None]),
    _changed(fields="absent"),
    _changed(fields=None),
    _changed(fields=[{"name": "x"}]),
    _changed(fields=[{"type": "long"}]),
    _changed(fields=[{"name": "x", "type": "long"}, {"name": "y", "type": "long", "required": None}]),
    _changed(fields=[{"name": "x", "type": "long", "required": "no"}]),
    _changed(fields=[5]),
    _changed(schema_id=1.5),
    _changed(schema_id=2**31),
    _changed(schema_id="7"),
    '{"table":"t","table":"u","namespace":[],"fields":[]}',
]


def test_validity(spark):
    decoded = decode(registration_frames(spark, list(enumerate(GOOD + BAD))))
    found = {r.seq: r.ok for r in registrations(decoded).collect()}
    assert found == {i: i < len(GOOD) for i in range(len(GOOD) + len(BAD))}
    known = registry(registrations(decoded))
    answers = {r.seq: r.msg for r in outcomes(admit(decoded, known)).collect()}
    assert answers == {i: None if i < len(GOOD) else BAD_REGISTRATION for i in found}


def test_bytes_that_are_not_utf8(spark):
    frames = registration_frames(spark, [(0, "{}")]).withColumn("frame", F.unhex(F.lit("01FFFE")))
    assert [r.ok for r in registrations(decode(frames)).collect()] == [False]


def test_newest_registration_wins_and_required_defaults_to_true(spark):
    fields = [{"name": "x", "type": "int"}, {"name": "y", "type": "nope", "required": False}]
    messages = [
        (5, _changed(namespace=["old"])),
        (9, _changed(namespace=["new"], fields=fields)),
        (7, _changed(namespace=["between"])),
        (10, "broken"),
    ]
    known = registry(registrations(decode(registration_frames(spark, messages))))
    row = known.first()
    assert (row.table, row.first_seq, row.last_seq) == ("t", 5, 9)
    (schema,) = table_schemas(known)
    assert schema.namespace == ("new",)
    assert schema.fields == (Field("x", "int", True), Field("y", "nope", False))
    assert schema.struct_type().simpleString() == "struct<x:int,y:string>"
    assert [f.nullable for f in schema.struct_type().fields] == [False, True]


def test_records_without_a_schema(spark):
    from sluicegate.operators.registry import with_schema
    from sluicegate.operators.typing import unregistered_rows

    known = registry(registrations(decode(registration_frames(spark, [(5, GOOD[0])]))))
    rows = [(1, "t", "{}", None), (2, "u", "{}", None), (3, None, None, b"z")]
    records = spark.createDataFrame(rows, "seq bigint, table string, payload string, frame binary")
    for limits in ({}, {"max_rows": 0, "salts": 4}):
        found = with_schema(records, known, **limits)
        assert {r.seq: r.namespace for r in found.collect()} == {1: ["a", "b"], 2: None, 3: None}
        dropped = {r.seq: (r.reason, r.frame) for r in unregistered_rows(found).collect()}
        assert dropped == {2: ("no schema registered", None), 3: ("no schema registered", b"z")}
