"""Registered queries against the same question asked in DuckDB, where SQL can express it."""

import pytest

import __spark_entry__ as entry_points
import oracle
from sluicegate.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck():
    return oracle.connect("/root/testdata/sf0.001")


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches(spark, duck, sf_dir, name):
    assert oracle.spark_rows(QUERIES[name](spark, sf_dir)) == oracle.duck_rows(duck, ORACLE_SQL[name])
