"""Every registered query against the same question asked of the original tables in DuckDB."""

import pytest

import __spark_entry__ as entry_points
import oracle
from sluicegate.plans.queries import QUERIES

ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir="/root/testdata/sf0.001"):
    return oracle.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, duck, sf_dir, name):
    assert oracle.spark_rows(QUERIES[name](spark, sf_dir)) == oracle.duck_rows(duck, ORACLE[name])


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["table", "received", "admitted", "malformed", "bad", "stored"]
