"""The mix against its bounds, slot by slot."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=6))
def test_period_stays_within_one_block(shares):
    active = {f"s{i}": a for i, a in enumerate(shares)}
    slots = mixing.period(active)
    assert Counter(slots) == active
    had = Counter()
    for t, source in enumerate(slots, 1):
        had[source] += 1
        assert all(abs(had[s] - a * t / len(slots)) < 1 for s, a in active.items())


def plain_slots(blocks, weights):
    """Slot of each block: earliest deadline first by search over all sources, those that have run out included."""
    total, had, slots, t = sum(weights.values()), dict.fromkeys(weights, 0), {}, 0
    while len(slots) < sum(blocks.values()):
        _, source = min((-(-(had[s] + 1) * total // w), s) for s, w in weights.items() if had[s] * total // w <= t)
        if had[source] < blocks.get(source, 0):
            slots[source, had[source]] = t
        had[source] += 1
        t += 1
    return slots


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=6), st.integers(1, 3))
def test_period_equals_a_plain_scheduler(shares, periods):
    active = {f"s{i}": a for i, a in enumerate(shares)}
    slots = plain_slots({s: a * periods for s, a in active.items()}, active)
    assert [s for s, _ in sorted(slots, key=slots.get)] == mixing.period(active) * periods


def test_shares():
    assert mixing.shares({"a": 1, "b": 1}, 1, 10) == {"a": 4, "b": 3, "": 3} or sum(mixing.shares({"a": 1, "b": 1}, 1, 10).values()) == 10
    assert mixing.shares({"a": 1e-9}, 1.0, 100)["a"] == 1
    assert mixing.shares({"a": 1.0, "b": 0.0}, 0.0) == {"a": 1000}
    with pytest.raises(ValueError, match="negative"):
        mixing.shares({"a": -1.0}, 1.0)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    weights = {"src0": 0.25, "src1": 0.15, "src2": 0.1}
    rows = mixing.mixed(docs, weights, 0.5, block_rows=4).collect()
    by_source = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        by_source.setdefault(r["source"] if r["source"] in weights else "", []).append(r)
    slot = plain_slots({s: -(-len(x) // 4) for s, x in by_source.items()}, mixing.shares(weights, 0.5))
    for source, own in by_source.items():
        for rank, r in enumerate(own):
            block = rank // 4
            assert (r["block"], r["slot"], r["position"]) == (block, slot[source, block], slot[source, block] * 4 + rank % 4)
    assert len({r["position"] for r in rows}) == docs.count()


def test_order_in_files(spark, root):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    weights = {"src0": 0.5}
    mixing.in_mixed_order(docs, weights, 0.5, block_rows=2).write.parquet(f"{root}/mix")
    stored = spark.read.parquet(f"{root}/mix").select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    order = [r["doc_id"] for r in sorted(stored, key=lambda r: (r["file_name"], r["row_index"]))]
    want = [r["doc_id"] for r in mixing.mixed(docs, weights, 0.5, block_rows=2).orderBy("position").collect()]
    assert order == want


def test_source_with_rows_needs_a_weight(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(ValueError, match="positive weight"):
        mixing.mixed(docs, {"a": 1.0}, 0.0)
