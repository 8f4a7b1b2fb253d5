"""The prefix trie against a plain trie of Python dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluicegate.llm import conversation_trie
from sluicegate.llm.queries import op11_conversation_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KIND = "conv_id long, turn long, role string, text string"


def plain_paths(rows, rebuild=True):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    if not rebuild:
        return turns
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return paths


def plain_nodes(paths):
    members, found = defaultdict(list), []
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    totals = {}
    for key in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children[key]]
        saved = (len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0
        totals[key] = (sum(b[0] for b in below) if below else 1, saved + sum(b[1] for b in below))
    for key, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        found.append((min(ids), len(key), parent, len(ids), len(children[key]), *totals[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def spark_nodes(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(params=["usual", "small"])
def sizes(request, monkeypatch):
    """Small blocks, parts and sketches, so that conversations span blocks and most prefixes are not cleared."""
    if request.param == "small":
        for name, value in {"BLOCK": 3, "MIN_WIDTH": 4096, "MAX_WIDTH": 4096, "IDS_A_PART": 3}.items():
            monkeypatch.setattr(conversation_trie, name, value)
        monkeypatch.setattr(conversation_trie, "SKETCH_ROWS", 1)


def test_query(spark, sf_dir, sizes):
    rows = rows_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert spark_nodes(op11_conversation_trie(spark, sf_dir)) == plain_nodes(plain_paths(rows))


def odd_rows():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "system", None]), rng.choice(["a", "é", "", None])) for c in range(60) for t in range(rng.randint(1, 12))]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 140) for t in range(11)]
    rows += [(200, None, "x", "first"), (200, None, "x", "first"), (200, 1, "y", "tie"), (200, 1, "x", "tie"), (None, 1, "user", "lost")]
    rows += [(300, t, "user", "long" * (t % 3)) for t in range(2500)] + [(301, t, "user", "long" * (t % 3)) for t in range(2500)]
    rows += [(c, 0, "user", "only") for c in (401, 402, 403, 404, 411, 9, 2)]
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_odd_conversations(spark, sizes, rebuild):
    rows = odd_rows()
    made = spark.createDataFrame(rows, KIND).repartition(6)
    made = made.withColumns({c: F.lit("clash") for c in ("i", "d", "a", "p1", "n", "length", "_block", "_place", "least", "bytes")})
    parts = conversation_trie.rebuilt(made) if rebuild else conversation_trie.as_they_are(made)
    assert spark_nodes(conversation_trie.nodes(*parts)) == plain_nodes(plain_paths(rows, rebuild))


def test_turnless_and_empty(spark):
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:6]
    rows = [(c, 0, "user", "gone") for c in ids if c - c % 5 not in ids]
    made = spark.createDataFrame(rows, KIND)
    found = spark_nodes(conversation_trie.nodes(*conversation_trie.rebuilt(made)))
    assert found == plain_nodes(plain_paths(rows)) and found[0][3:6] == (len(rows), 0, 1)
    assert conversation_trie.nodes(*conversation_trie.rebuilt(made.limit(0))).count() == 0


def test_screening_keeps_unique_tails_out_of_the_shuffle(spark):
    made = spark.range(500).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("turn"))
    made = made.withColumns({"role": F.lit("user"), "text": F.when(F.col("turn") == 0, "same").otherwise(F.concat("conv_id", F.lit("-"), "turn"))})
    turns, _ = conversation_trie.as_they_are(made)
    flagged = conversation_trie.screened(turns.select(F.xxhash64("d", "a").alias("p1"), F.xxhash64("b", "d").alias("p2"), "d"), ("alone", ("p1", "p2")))
    cleared = {r["d"]: r["n"] for r in flagged.where("alone").groupBy("d").agg(F.count("*").alias("n")).collect()}
    assert 1 not in cleared and sum(cleared.values()) >= 0.99 * 2500
