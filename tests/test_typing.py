import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluicegate.operators import typing as ty
from sluicegate.operators.registry import Field, TableSchema

SCHEMA = TableSchema("t", ("n",), (Field("a", "long"), Field("b", "double", False), Field("s", "string", False)))
CASES = [
    ('{"a":1,"b":2.5,"s":"x"}', None),
    ('{"s":"x","zzz":{"k":[1]},"a":1}', None),
    ('{"a":"1"}', None),
    ('{"a":1} trailing', None),
    ('{"a":1,"a":2}', None),
    ('{"a":1,"b":null}', None),
    ('{"a":null}', "missing required field 'a'"),
    ("{}", "missing required field 'a'"),
    ('{"a":"x","b":"y"}', "bad value for 'a'"),
    ('{"a":1,"b":"y"}', "bad value for 'b'"),
    ('{"b":"y"}', "missing required field 'a'"),
    ('{"a":1', ty.MALFORMED),
    ("", ty.MALFORMED),
    (" ", ty.MALFORMED),
    (None, ty.MALFORMED),
    ("{'a':1}", ty.MALFORMED),
    ('{"a":NaN}', ty.MALFORMED),
    ("[1", ty.MALFORMED),
    ("5", ty.NOT_AN_OBJECT),
    ("null", ty.NOT_AN_OBJECT),
    ('[{"a":1}]', ty.NOT_AN_OBJECT),
]


@pytest.fixture
def records(spark):
    rows = [(i, "t", p, None) for i, (p, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "seq bigint, table string, payload string, frame binary")


def test_reasons(records):
    found = {r.seq: r.reason for r in ty.rejected_rows(records, SCHEMA).collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES) if reason}


def test_good_rows(records):
    rows = sorted(tuple(r) for r in ty.typed_rows(records, SCHEMA, ordered=True).fillna({"b": -1, "s": "-"}).collect())
    assert rows == [(1, -1, "-")] * 3 + [(1, -1, "x"), (1, 2.5, "x"), (2, -1, "-")]


def test_split_agrees_with_the_two_halves(records):
    split = ty.split_rows(records, SCHEMA, ordered=True)
    good = split.where(~F.col("_rejected")).select("a", "b", "s")
    assert sorted(map(str, good.collect())) == sorted(map(str, ty.typed_rows(records, SCHEMA).collect()))
    bad = split.where("_rejected").select("_reject.*")
    assert sorted(map(str, bad.collect())) == sorted(map(str, ty.rejected_rows(records, SCHEMA).collect()))


def test_fail_stops_on_bad_rows_only(records):
    malformed_only = records.where(F.col("seq").isin(0, 11, 12))
    assert ty.typed_rows(malformed_only, SCHEMA, "fail").count() == 1
    for seq in (6, 8, 18):
        with pytest.raises(PySparkException, match="table 't'"):
            ty.typed_rows(records.where(F.col("seq") == seq), SCHEMA, "fail").collect()
    with pytest.raises(ValueError):
        ty.typed_rows(records, SCHEMA, "ignore")


def registry_of(spark, schemas):
    rows = [(s.table, list(s.namespace), [(f.name, f.type, f.required) for f in s.fields]) for s in schemas]
    return spark.createDataFrame(
        rows, "table string, namespace array<string>, fields array<struct<name: string, type: string, required: boolean>>"
    )


def test_many_tables_in_one_pass(spark, records):
    other = TableSchema("u", ("n",), (Field("a", "boolean"),))
    third = TableSchema("v", ("n",), (Field("s", "string"),))
    both = records.unionByName(records.withColumn("table", F.lit("u"))).unionByName(
        records.withColumn("table", F.lit("elsewhere"))
    )
    found = ty.with_reasons(both, registry_of(spark, [SCHEMA, other, third]))
    assert found.count() == 3 * len(CASES)
    by_table = {t: {r.seq: r.reason for r in found.where(F.col("table") == t).collect()} for t in ("t", "u", "elsewhere")}
    assert by_table["t"] == {i: reason for i, (_, reason) in enumerate(CASES)}
    expected = {r.seq: r.reason for r in ty.rejected_rows(records, other).collect()}
    assert {i: r for i, r in by_table["u"].items() if r} == expected
    assert set(by_table["elsewhere"].values()) == {None}
    assert {r.table: r.registered for r in found.select("table", "registered").distinct().collect()} == {"t": True, "u": True, "elsewhere": False}


def test_reasons_of_all_types_are_those_of_the_typed_rows(spark):
    from sluicegate.functions.field_types import SPELLINGS

    texts = ["1", "x", "1.5", "true", "2024-01-31", "2024-01-31T10:11:12Z", "1d", "ABC", "AB", "", "-7", "99999999999"]
    payloads = [f'{{"v":"{t}"}}' for t in texts] + ['{"v":7}', '{"v":1e3}', '{"v":{"k":1}}', '{"v":[1]}', '{"v":true}']
    rows = [(i, t, p, None) for t in SPELLINGS for i, p in enumerate(payloads)]
    records = spark.createDataFrame(rows, "seq bigint, table string, payload string, frame binary")
    schemas = [TableSchema(t, ("n",), (Field("v", t),)) for t in SPELLINGS]
    found = {(r.table, r.seq): r.reason for r in ty.with_reasons(records, registry_of(spark, schemas)).collect()}
    for schema in schemas:
        own = {r.seq: r.reason for r in ty.rejected_rows(records.where(F.col("table") == schema.table), schema).collect()}
        assert own == {i: reason for (t, i), reason in found.items() if t == schema.table and reason}


def test_columns_declared_twice(spark, records):
    twice = TableSchema("t", ("n",), (Field("a", "long"), Field("A", "string")))
    with pytest.raises(ty.AmbiguousFields):
        ty.typed_rows(records, twice)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert ty.typed_rows(records.where("seq = 0"), TableSchema("t", ("n",), (Field("a", "long"), Field("A", "string", False)))).collect() == [(1, None)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_odd_field_names(spark):
    fields = (Field("a.b", "long"), Field("c`d", "long"), Field("_broken", "long"), Field("seq", "string"), Field("", "long", False), Field("q's\\", "long"))
    payload = '{"a.b":1,"c`d":2,"_broken":3,"seq":"four","q\'s\\\\":5}'
    rows = spark.createDataFrame([(0, "t", payload, None)], "seq bigint, table string, payload string, frame binary")
    schema = TableSchema("t", ("n",), fields)
    assert [tuple(r) for r in ty.typed_rows(rows, schema).collect()] == [(1, 2, 3, "four", None, 5)]
    assert ty.split_rows(rows, schema, ordered=True).collect()[0][:6] == (1, 2, 3, "four", None, 5)
    wrong = rows.withColumn("payload", F.lit('{"a.b":1,"c`d":2,"_broken":3,"seq":"four"}'))
    assert ty.rejected_rows(wrong, schema).first().reason == "missing required field 'q's\\'"


def test_repeated_keys_have_their_last_value_in_both_ways(spark):
    payloads = ['{"x":1,"x":"no"}', '{"x":"no","x":2}', '{"s":"a","x":1,"s":"b","x":null}', '{"x":3,"s":"c"}']
    rows = [(i, "t", p, None, None) for i, p in enumerate(payloads)]
    records = spark.createDataFrame(rows, "seq long, table string, payload string, frame binary, msg string")
    known = spark.createDataFrame([("t", ["n"], [("x", "long", True), ("s", "string", False)])], "table string, namespace array<string>, fields array<struct<name: string, type: string, required: boolean>>")
    schema = TableSchema("t", ("n",), (Field("x", "long"), Field("s", "string", False)))
    summary = {r["seq"]: r["reason"] for r in ty.with_reasons(records, known).collect() if r["reason"]}
    assert summary == {r["seq"]: r["reason"] for r in ty.rejected_rows(records, schema).collect()} and set(summary) == {0, 2}
