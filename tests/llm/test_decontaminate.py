"""Leaks against shingle containment by brute force."""

import random

import pytest

from sluicegate.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def shingle_set(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_matches(docs, items):
    wanted = {}
    for i, text in items:
        q, a = D.question_and_answer(text)
        if q or a:
            wanted[i] = (shingle_set(q), shingle_set(a), {len(p) for p in (q, a) if 0 < len(p) < 5})
    found = set()
    for doc_id, text in docs:
        words = D.words_of(text)
        for i, (q, a, short) in wanted.items():
            here = shingle_set(words)
            for n in short:
                here |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            if len(q & here) + len(a & here) >= 0.8 * (len(q) + len(a)):
                found.add((doc_id, i))
    return found


def test_documents(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in D.matches(docs, items).collect()}
    want = plain_matches(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert found == want and len(want) > 5
    clean = {r["doc_id"] for r in D.without_leaks(docs, items).collect()}
    assert clean == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_placed_items(spark, shard_bytes, monkeypatch):
    monkeypatch.setattr(D, "CELLS_AT_ONCE", 400)
    make = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(make.choices(vocabulary, k=n))
    items = [(i, f"{text(make.randint(6, 30))}? {text(make.randint(5, 12))}.") for i in range(20)]
    docs = [(i, text(make.randint(0, 400))) for i in range(60)]
    for i in range(60, 120):
        words = items[i % 20][1].split()
        if i % 3 == 1:
            words[len(words) // 2] = "changed"
        if i % 3 == 2:
            words = words[: len(words) // 2]
        docs.append((i, f"{text(make.randint(0, 300))} {' '.join(words).upper()} {text(make.randint(0, 300))}"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "SHARD_BYTES", shard_bytes)
    assert (len(D.indexes(benchmark, shard_bytes)) > 1) == (shard_bytes == 300)
    found = [D.Search(x).texts([D.Search(x).numbers(t) for _, t in docs]) for x in D.indexes(benchmark, shard_bytes)]
    pairs = {(d, x.ids[i]) for x, per in zip(D.indexes(benchmark, shard_bytes), found) for (d, _), m in zip(docs, per) for i in m}
    assert pairs == plain_matches(docs, items)
    whole = {(r["doc_id"], r["item_id"]) for r in D.matches(frame, benchmark).collect()}
    assert whole == pairs and {(d, d % 20) for d in range(60, 120, 3)} <= pairs
