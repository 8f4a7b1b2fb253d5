"""The bitmap of ids against plain membership, also when it is too small for them."""

import pytest

from sluicegate.llm import screen


@pytest.mark.parametrize("most_bits", [screen.MOST_BITS, 1 << 15])
def test_rows_with_an_id(spark, monkeypatch, most_bits):
    monkeypatch.setattr(screen, "MOST_BITS", most_bits)
    table = spark.range(-3000, 60000, 1, 7).withColumnRenamed("id", "rid").unionByName(spark.range(40).withColumnRenamed("id", "rid"))
    ids = spark.range(-3000, 60000, 3, 2).withColumnRenamed("id", "rid")
    want = set(range(-3000, 60000, 3))
    passed = {r["rid"] for r in table.where(screen.may_be_in(ids, "rid")).collect()}
    assert want <= passed
    # one in 16 of the 42,000 others; about half of them where 21,000 ids meet in 32,768 bits
    assert len(passed - want) < 42000 * (0.08 if most_bits > 1 << 15 else 0.6)
    left = sorted(r["rid"] for r in screen.without(table, ids, "rid").collect())
    assert left == sorted([i for i in range(-3000, 60000) if i not in want] + [i for i in range(40) if i not in want])


def test_no_ids(spark):
    table = spark.range(100).withColumnRenamed("id", "rid")
    none = table.where("rid < 0")
    assert table.where(screen.may_be_in(none, "rid")).isEmpty()
    assert screen.without(table, none, "rid").count() == 100 and screen.without(none, table, "rid").isEmpty()
