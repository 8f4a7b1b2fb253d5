from decimal import Decimal

from pyspark.sql import functions as F

from sluicegate.functions.names import generation_number
from sluicegate.operators import generations as gens

CASES = [
    ("active", 0),
    ("active_1780124079", 1780124079),
    ("active_0", 0),
    ("active_18446744073709551615", 18446744073709551615),
    ("active_18446744073709551616", None),
    ("active_" + "9" * 60, None),
    ("active_-1", None),
    ("default", None),
    ("frozen_1780124079", None),
    ("active_notnumeric", None),
    ("active_", None),
    ("activex", None),
    ("", None),
]


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_numbers(spark):
    names = _names(spark, [n for n, _ in CASES])
    found = {r.name: r.n for r in names.select("name", generation_number(F.col("name")).alias("n")).collect()}
    assert found == {n: None if v is None else Decimal(v) for n, v in CASES}


def test_newest_after_a_digit_boundary(spark):
    names = _names(spark, ["active_9999999999", "active_10000000000", "active", "default"])
    assert gens.newest(names).first().name == "active_10000000000"
    found = {r.name: r.role for r in gens.roles(names).collect()}
    assert found == {"active": "orphan", "active_9999999999": "orphan", "active_10000000000": "active"}


def test_no_generations(spark):
    assert gens.newest(_names(spark, ["default"])).isEmpty()
    assert gens.roles(_names(spark, ["default"])).isEmpty()


def test_pending_and_work_order(spark):
    ledger = spark.createDataFrame(
        [(1, "a", True), (1, "b", True), (2, "a", True), (2, "b", False), (4, "a", None)],
        "gen bigint, table string, committed boolean",
    )
    seen = spark.createDataFrame([(g,) for g in (1, 2, 3, 4)], "gen bigint")
    assert sorted(r.gen for r in gens.pending(seen, ledger).collect()) == [2, 3, 4]
    orphans = spark.createDataFrame([("c", 30), ("a", 10), ("b", 20)], "name string, number bigint")
    frozen = spark.createDataFrame([("f", 5)], "name string, number bigint")
    assert [r.name for r in gens.work_list(orphans, frozen).collect()] == ["a", "b", "c", "f"]


def test_extent_of_an_empty_generation(spark):
    empty = spark.createDataFrame([], "seq bigint")
    assert gens.extent(empty).first().next_seq == 1
