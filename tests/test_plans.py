"""The physical plans that scale depends on, and exact round trips."""

import pytest
from pyspark.sql import functions as F

from sluicegate.operators.decode import admit, decode, records_of
from sluicegate.operators.registry import TableSchema
from sluicegate.operators.reports import ingest_summary
from sluicegate.operators.typing import rejected_rows, split_rows, typed_rows
from sluicegate.plans.fixtures import fields_of, record_frames
from sluicegate.session import tuned_session
from sluicegate.sources.frames import read_frames, read_generation, write_frames

TABLES = {
    "events": "event_id", "lineitem": "l_orderkey", "documents": "doc_id", "orders": "o_orderkey",
    "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey",
    "pages": "page_id", "conversations": "conv_id", "labels": "doc_id", "benchmark": "item_id",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, root, events):
    path = f"{root}/frames"
    record_frames(events, "events", "event_id", "ts").write.parquet(path)
    return read_frames(spark, path)


@pytest.fixture
def known(spark):
    return spark.createDataFrame([("events", -1)], "table string, first_seq bigint")


@pytest.mark.parametrize("name", sorted(TABLES))
def test_round_trip(spark, sf_dir, name):
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    schema = TableSchema(name, ("n",), tuple(fields_of(table.schema, required=False)))
    back = typed_rows(decode(record_frames(table, name, TABLES[name])), schema)
    assert back.schema.simpleString() == table.schema.simpleString()
    assert back.exceptAll(table).isEmpty() and table.exceptAll(back).isEmpty()


def test_typed_rows_parse_once_and_never_shuffle_the_frames(stored, known, events):
    schema = TableSchema("events", ("n",), tuple(fields_of(events.schema)))
    records = records_of(admit(decode(stored), known), "events")
    for df in (typed_rows(records, schema), rejected_rows(records, schema), split_rows(records, schema)):
        plan = plan_of(df)
        assert plan.count("from_json") == 1
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_columns_that_are_not_needed_are_not_read(stored):
    plan = plan_of(decode(stored).groupBy("kind").count())
    assert "ReadSchema: struct<frame:binary>" in plan


@pytest.mark.parametrize("tables", [3, 33, 320])
def test_summary_is_one_scan_with_partial_aggregation(spark, stored, known, events, tables):
    fields = [(f.name, f.type, f.required) for f in fields_of(events.schema)]
    rows = [(n, ["n"], fields) for n in ["events", *[f"t{i}" for i in range(tables - 1)]]]
    kinds = "table string, namespace array<string>, fields array<struct<name: string, type: string, required: boolean>>"
    plan = plan_of(ingest_summary(admit(decode(stored), known), spark.createDataFrame(rows, kinds)))
    assert plan.count("FileScan parquet") == 1 and "partial_count" in plan and plan.count("from_json") == 1


@pytest.mark.parametrize("ordered", [False, True])
def test_casts_are_planned_once(stored, events, ordered):
    schema = TableSchema("events", ("n",), tuple(fields_of(events.schema)))
    optimized = split_rows(decode(stored), schema, ordered=ordered)._jdf.queryExecution().optimizedPlan().toString()
    # event_id, user_id and value, and three ways to write the instant.
    assert optimized.count("try_cast") == 6


def test_generation_scan_is_pruned(spark, root, stored):
    for gen in (0, 1):
        write_frames(stored, f"{root}/gens", gen)
    scan = read_generation(spark, f"{root}/gens", 1)
    assert "PartitionFilters: [isnotnull(gen" in plan_of(scan)
    assert scan.count() == stored.count()
    ordered = read_generation(spark, f"{root}/gens", 1, ordered=True).select("seq").limit(3).collect()
    assert [r.seq for r in ordered] == [0, 1, 2]


def test_ordered_typing_sorts_inside_partitions_only(stored, events):
    schema = TableSchema("events", ("n",), tuple(fields_of(events.schema)))
    plan = plan_of(typed_rows(decode(stored), schema, ordered=True))
    assert "Sort [seq" in plan and "Exchange" not in plan


def test_session_settings(spark):
    assert tuned_session("again").conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"


def test_committed_rows_are_pruned_by_generation(spark, root, events):
    from sluicegate.sinks.targets import FolderTarget, committed_rows

    schema = TableSchema("events", ("n",), tuple(fields_of(events.schema)))
    target = FolderTarget(root)
    split = split_rows(decode(record_frames(events, "events", "event_id")), schema)
    for gen in (0, 1, 2):
        target.replace_generation(split, schema, gen)
    ledger = spark.createDataFrame(
        [(0, "events", 1, True), (1, "events", None, False), (2, "other", 1, True)],
        "gen bigint, table string, rows bigint, committed boolean",
    )
    rows = committed_rows(spark, target, schema, ledger)
    plan = plan_of(rows)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    assert rows.exceptAll(events).isEmpty() and events.exceptAll(rows).isEmpty()
