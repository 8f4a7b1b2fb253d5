"""Every source of the table has a window of its own in the mix."""

from sluicegate.llm import mixing, queries


def test_weights(spark):
    rows = [(i, s) for i, s in enumerate(["a"] * 3 + ["b"] * 6 + ["c"] * 2 + [None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    assert mixing.every_source(docs, {"a": 0.5, "z": 0.1}, 0.4) == ({"a": 0.5, "z": 0.1, "b": 0.4 * 6 / 10, "c": 0.4 * 2 / 10}, 0.4 * 2 / 10)
    assert mixing.every_source(docs.where("source = 'a'"), {"a": 0.5}, 0.4) == ({"a": 0.5}, 0.4)


def test_no_source_runs_alone(spark):
    rows = sorted(queries.op3_mixing(spark, "/root/testdata/sf0.1").collect(), key=lambda r: r["position"])
    weights = {r["source"]: 0.5 / 17 for r in rows} | queries.SOURCE_WEIGHTS
    n = {s: 0 for s in weights}
    for r in rows:
        n[r["source"]] += 1
    assert len(rows) == len({r["doc_id"] for r in rows}) == 10_000 and set(n.values()) == {500}
    # until the first source runs out, each has its share of the slots, give or take one block and the rounding of shares
    first_out = min(max(r["slot"] for r in rows if r["source"] == s) for s in n)
    had = dict.fromkeys(n, 0)
    for t, source in enumerate((s for _, s in sorted({(r["slot"], r["source"]) for r in rows if r["slot"] <= first_out})), 1):
        had[source] += 1
        assert all(abs(had[s] - w * t) < 1.5 for s, w in weights.items())
    # the unnamed sources stay mixed to the end: in any 17 blocks of theirs none has more than 2, so at least 9 stand there
    others = [s for _, s in sorted({(r["slot"], r["source"]) for r in rows if r["source"] not in queries.SOURCE_WEIGHTS})]
    assert all(len(set(others[i : i + 17])) >= 9 for i in range(len(others) - 16))


def test_hot_source_is_spread(spark):
    rows = [(i, "hot" if i < 400 else f"s{i % 8}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    placed = mixing.mixed(docs, *mixing.every_source(docs, {}, 1.0), block_rows=4).collect()
    slots = sorted({(r["slot"], r["source"]) for r in placed})
    # less than one block in each of two phases
    assert all(abs(sum(s == "hot" for _, s in slots[:t]) - t / 3) < 2 for t in range(1, len(slots) + 1))


def test_named_weights_hold_with_many_sources(spark):
    rows = [(i, "src0" if i < 2000 else f"other{i % 2000}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights, rest = mixing.every_source(docs, {"src0": 0.25}, 0.75)
    assert len(weights) == 2001
    placed = mixing.mixed(docs, weights, rest, block_rows=1).collect()
    order = [r["source"] for r in sorted(placed, key=lambda r: r["position"])]
    assert len(placed) == len({r["slot"] for r in placed}) == 8000
    had = 0
    for t, s in enumerate(order, 1):
        had += s == "src0"
        assert abs(had - 0.25 * t) < 1


def test_shares_of_many():
    shared = mixing.shares({"a": 0.25, **{f"s{i}": 0.75 / 5000 for i in range(5000)}}, 0.0, 500_100)
    assert sum(shared.values()) == 500_100 and shared["a"] == 125_025
    shared = mixing.shares({"a": 0.25, "b": 0.75, **{f"s{i}": 1e-9 for i in range(100)}}, 0.0, 10_300)
    assert sum(shared.values()) == 10_300 and abs(shared["a"] / 10_300 - 0.25) < 0.25 / 100


def test_names_in_the_way(spark):
    docs = spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "doc_id long, source string, slot int")
    placed = mixing.mixed(docs, {"a": 0.5, "b": 0.5}, 0.0)
    assert placed.columns == ["doc_id", "source", "slot", "block", "_slot", "position"]
    assert sorted((r["doc_id"], r["slot"], r["_slot"]) for r in placed.collect()) == [(1, 7, 0), (2, 8, 1)]
