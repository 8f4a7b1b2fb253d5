"""Spelling variants against a plain search over all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluicegate.llm import spelling_variants
from sluicegate.llm.queries import op12_spelling_variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
ASCII = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    # Words that agree when one place is left out, or when one letter is deleted.
    by_hole, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            by_hole[w[:i], w[i + 1 :]].add(w)
    for (left, right), found in by_hole.items():
        for w in found:
            near[w] |= found - {w}
            if left + right in counts and left + right != w:
                near[w].add(left + right)
                near[left + right].add(w)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(rows, key=repr)


def spark_rows(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = spark_rows(op12_spelling_variants(spark, sf_dir))
    assert found == plain_variants(plain_words(rows))
    assert any(r[1] for r in found)


def odd_docs():
    rng = random.Random(5)
    letters = "abÿ×"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(4, 6))) for _ in range(500)) for _ in range(20)]
    chain = " ".join(" ".join(["chain" + "x" * k] * 3 * 2**k) for k in range(7))
    return [*enumerate(texts), (100, chain), (101, "Éclair éclair ÉCLAIR " * 4), (102, "aaaaab aaaab aaaaaab " * 5), (103, None), (104, ""), (None, "nulls nulls nully " * 4), (1, texts[1]), (105, "y" * 50_000 + " " + "y" * 50_000 + " " + "y" * 50_000)]


@pytest.mark.parametrize(("strip", "tile"), [(1024, 8192), (7, 8192), (16, 5)])
def test_odd_words(spark, monkeypatch, strip, tile):
    monkeypatch.setattr(spelling_variants, "STRIP", strip)
    rows = odd_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("word", "n", "run", "doc", "block", "root", "size")})
    want = plain_variants(plain_words(rows))
    assert spark_rows(spelling_variants.variants(docs, tile=tile)) == want
    assert len({r[2] for r in want if r[0].startswith("chain")}) == 1 and max(r[4] for r in want) > 10


def test_empty(spark):
    docs = spark.createDataFrame([(1, "too few words"), (2, None)], "doc_id long, text string")
    assert spelling_variants.variants(docs).count() == 0
    assert spelling_variants.variants(docs.limit(0)).count() == 0


def test_gram_distances_bound_an_edit():
    rng = random.Random(2)
    for _ in range(500):
        a = "".join(rng.choice("abcÀé") for _ in range(6))
        i = rng.randrange(6)
        for b in (a[:i] + rng.choice("abcÀé") + a[i + 1 :], a[:i] + rng.choice("abcÀé") + a[i:]):
            x, y = spelling_variants.letter_counts([a, b])
            assert ((x - y) ** 2).sum() <= spelling_variants.MAX_SQUARED
            assert spelling_variants.is_edit(a, b) == (a != b)
