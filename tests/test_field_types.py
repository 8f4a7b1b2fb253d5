from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sluicegate.functions import field_types as ft

SPELLINGS = [
    ("string", "string"), ("long", "long"), ("int", "int"), ("double", "double"), ("float", "float"),
    ("boolean", "boolean"), ("timestamptz", "timestamptz"), ("timestamp", "timestamp"), ("date", "date"),
    ("binary", "binary"), ("int64", "long"), ("int32", "int"), ("float64", "double"), ("float32", "float"),
    ("bytes", "binary"),
]
UNKNOWN = ["strnig", "", "uuid", "Long", " long", "decimal"]

TEN = datetime(2026, 5, 30, 7, 30, 2, 123456)
CASTS = [
    ("string", "x", "x"), ("string", "", ""),
    ("long", "9223372036854775807", 2**63 - 1), ("long", "9223372036854775808", None), ("long", "1.7", None),
    ("long", "abc", None), ("int", "-5", -5), ("int", "2147483648", None),
    ("double", "1.5", 1.5), ("double", "1e3", 1000.0), ("double", "1d", None), ("double", "x", None),
    ("double", "inf", float("inf")), ("float", "0.5", 0.5), ("float", "2f", None),
    ("boolean", "true", True), ("boolean", "false", False), ("boolean", "TRUE", None), ("boolean", "1", None),
    ("timestamp", "2026-05-30T07:30:02.123456", TEN), ("timestamp", "2026-05-30 07:30:02.123456", TEN),
    ("timestamp", "2026-05-30T09:30:02.123456+02:00", TEN), ("timestamp", "2026-05-30T07:30:02.123456z", TEN),
    ("timestamp", "2026-05-30T05:00:02.123456-0230", TEN), ("timestamp", "2026-05-30T07:30:02.123456 UTC", None),
    ("timestamp", "2026-05-30", datetime(2026, 5, 30)), ("timestamp", "2026-05", None),
    ("timestamp", "2026-13-30T00:00:00", None), ("timestamp", "1780126202123456", TEN),
    ("date", "2026-05-30", date(2026, 5, 30)), ("date", "2026-05", None), ("date", "2026-02-30", None),
    ("date", "1", date(1970, 1, 2)), ("date", "-1", date(1969, 12, 31)),
    ("binary", "CAfe", b"\xca\xfe"), ("binary", "CAF", None), ("binary", "zz", None), ("binary", "", b""),
]


@pytest.mark.parametrize("spelling,expected", SPELLINGS)
def test_spelling(spelling, expected):
    assert ft.SPELLINGS[spelling] == expected and ft.resolve(spelling) == expected


def test_spellings_as_columns(spark):
    names = spark.createDataFrame([(s,) for s, _ in SPELLINGS] + [(u,) for u in UNKNOWN], "s string")
    rows = names.select("s", ft.resolve_column(F.col("s")).alias("t"), ft.is_unknown(F.col("s")).alias("u")).collect()
    expected = [(s, t, False) for s, t in SPELLINGS] + [(u, "string", True) for u in UNKNOWN]
    assert [tuple(r) for r in rows] == expected


@pytest.mark.parametrize("field_type", sorted(ft.SPARK_TYPES))
def test_cast_yields_the_declared_type(spark, field_type):
    row = spark.range(1).select(F.expr(ft.cast_sql("'x'", field_type)).alias("v"))
    assert row.schema["v"].dataType == ft.SPARK_TYPES[field_type]


def test_casts(spark):
    for field_type in {t for t, _, _ in CASTS}:
        cases = [(x, v) for t, x, v in CASTS if t == field_type]
        texts = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
        found = texts.select("i", F.expr(ft.cast_sql("x", field_type)).alias("v")).orderBy("i").collect()
        values = [bytes(r.v) if isinstance(r.v, bytearray) else r.v for r in found]
        assert values == [v for _, v in cases], field_type


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    micros = 1780126202123456
    texts = [
        "2026-05-30T07:30:02.123456Z", "2026-05-30T09:30:02.123456+02:00", "2026-05-30T07:30:02.123456",
        "2026-05-30 07:30:02.123456", str(micros),
    ]
    frame = spark.createDataFrame([(x,) for x in [*texts, "2026-05-30T07:30:02 Europe/Paris", "x"]], "x string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = frame.select(
            F.unix_micros(F.expr(ft.cast_sql("x", "timestamptz"))).alias("tz"),
            F.expr(ft.cast_sql("x", "timestamp")).cast("string").alias("naive"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.tz for r in found] == [micros] * 5 + [None, None]
    assert [r.naive for r in found] == ["2026-05-30 07:30:02.123456"] * 5 + [None, None]
