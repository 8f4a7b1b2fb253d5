"""Fingerprints and components against a plain version."""

import re

import numpy as np
import pytest
import xxhash

from sluicegate.llm import components, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_roots(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def test_blocks_leave_no_triple_uncovered():
    from itertools import combinations

    assert len(simhash.BLOCKS) == 14
    for differing in combinations(range(8), 3):
        assert any(not set(differing) & set(block) for block in simhash.BLOCKS)


@pytest.mark.parametrize("text", ["", None, "One", "one TWO", "É a b c\x0bd\x1ce", "a b c a b c a b c", "x y z\n" * 3])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_fingerprint_of_a_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 7)
    assert simhash.fingerprint(text) == plain_print(text)


def test_components_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = np.array([plain_print(r["text"]) for r in rows], np.uint64)
    pairs = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3)]
    roots = plain_roots(len(rows), pairs)
    want = [(r["doc_id"], f"{int(p):016x}", rows[k]["doc_id"]) for r, p, k in zip(rows, prints, roots)]
    assert sorted(map(tuple, simhash.assign(docs).collect())) == want
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert kept == {rows[k]["doc_id"] for k in roots}


def test_links_find_every_near_pair(spark):
    random = np.random.default_rng(5)
    base = random.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.array([[1 << int(b) for b in random.choice(64, 4, replace=False)] for _ in range(40)], np.uint64)
    prints = np.unique(np.concatenate([base, *[base ^ np.bitwise_xor.reduce(flips[:, :k], 1) for k in (1, 2, 3, 4)]]))
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    found = {tuple(sorted((r["u"], r["v"]))) for r in simhash.links(table).collect()}
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= 3
    signed = prints.view(np.int64)
    want = {tuple(sorted((int(signed[i]), int(signed[j])))) for i, j in zip(*np.nonzero(np.triu(near, 1)))}
    assert found == want and simhash.links(table).count() == len(want)


def test_components(spark):
    random = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 300, (200, 2))] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500 + i) for i in range(1, 60)]
    roots = plain_roots(600, pairs)
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {n: roots[n] for p in pairs for n in p if p[0] != p[1]}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
