"""Near copies against brute-force Jaccard of five-word shingles."""

import random
from itertools import combinations

from sluicegate.llm import near_copies, simhash
import corpus_pipeline
from test_simhash import LOWER, WORDS, plain_roots


def plain_set(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(zip(*(words[i:] for i in range(5))))


def plain_kept(rows):
    """Least id of each component of pairs at 0.8 or more; pairs are found through shared shingles."""
    rows = sorted(rows)
    sets = [plain_set(t) for _, t in rows]
    holding, shared = {}, {}
    for i, s in enumerate(sets):
        for shingle in s or [()]:
            holding.setdefault(shingle, []).append(i)
    for places in holding.values():
        for pair in combinations(places, 2):
            shared[pair] = shared.get(pair, 0) + 1
    near = [(i, j) for (i, j), n in shared.items() if not sets[i] or 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n)]
    return {rows[k][0] for k in plain_roots(len(rows), near)}


def stage_kept(spark, docs):
    return sorted(r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, None).collect())


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert stage_kept(spark, docs) == sorted(plain_kept([(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_planted(spark):
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words)]
    # of 100 shingles the first n stay: 0.8 has n / (200 - n) >= 0.8, so 89 are enough and 88 are not
    texts += [" ".join(words[: n + 4] + [f"{n}x{i}" for i in range(100 - n)]) for n in (88, 89)]
    texts += ["", None, " \n", "one two", "One  TWO", "one two three"]
    # a chain: each is near the next, the ends are not near each other
    texts += [" ".join(f"c{i}" for i in range(k, k + 104)) for k in range(0, 100, 5)]
    # a large group around one text, each with another word of its own
    texts += [" ".join([f"g{i}" for i in range(60)] + [f"own{k}"]) for k in range(80)]
    rows = list(enumerate(texts))
    kept = stage_kept(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept == sorted(plain_kept(rows)) == [0, 1, 3, 6, 8, 9, 29]


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = near_copies.shingle_set(text).tolist()
    monkeypatch.setattr(near_copies, "WORDS_AT_ONCE", 7)
    assert near_copies.shingle_set(text).tolist() == whole and len(whole) == 97


def test_a_group_that_shares_a_passage_and_is_not_similar(spark):
    # 400 texts of one passage and a quarter of their own words: similarities of about 0.6, and two true copies
    passage = [f"p{i}" for i in range(150)]
    texts = [" ".join(passage + [f"own{k}x{i}" for i in range(50)]) for k in range(400)]
    texts += [texts[7] + " end", "start " + texts[9]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    staged = docs.select("doc_id", docs["doc_id"].alias("rid"), "text")
    posted = near_copies.postings(staged, near_copies.rarity(staged))
    shared = posted.groupBy("value").count().where("count > 2")
    # The passage is common, so no list of it is posted.
    assert shared.isEmpty()
    assert stage_kept(spark, docs) == sorted(plain_kept(rows)) == list(range(400))


def test_any_order_of_shingles_finds_the_same(spark, monkeypatch):
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = stage_kept(spark, docs)
    monkeypatch.setattr(near_copies, "rarity", lambda texts: np.zeros(64, np.uint8))
    assert stage_kept(spark, docs) == want


def test_fingerprints_are_linked_first(spark, monkeypatch):
    # texts of 400 words and copies with another last word, most within 3 bits; the index of rare shingles does the rest
    texts = [" ".join([f"b{b}w{i}" for i in range(400)] + [f"own{k}"] * (k > 0)) for b in range(12) for k in range(4)]
    prints = [simhash.fingerprint(t, near_copies.SHINGLE) for t in texts]
    near = {(i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= simhash.MAX_BITS}
    assert near and all(i // 4 == j // 4 for i, j in near)
    tried, verified = [], near_copies._verified

    def spy(pairs, sets):
        tried.append(sorted((r["u"], r["v"]) for r in pairs.collect()))
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", spy)
    rows = list(enumerate(texts))
    # One partition, so that row numbers are the ids.
    kept = stage_kept(spark, spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert plain_roots(len(rows), tried[0]) == plain_roots(len(rows), near) and set(tried[0]) <= near
    assert kept == sorted(plain_kept(rows)) == list(range(0, len(rows), 4))


def test_parity_never_excludes_similar_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 63, len(a) // 9, dtype=np.uint64)]))
        odd = int(np.bitwise_count((near_copies.parity(a) ^ near_copies.parity(b)).view(np.uint64)).sum())
        assert odd <= len(np.setxor1d(a, b))
        assert odd <= (len(a) + len(b)) // 9 or not near_copies.similar(a.tobytes(), b.tobytes())


def test_a_group_below_the_similarity_makes_few_pairs(spark, monkeypatch):
    # 60 texts of 204 words, each with 4 words of its own: any two share rare shingles and are 0.67 similar
    rng, texts = random.Random(5), []
    for k in range(60):
        words = [f"g{i}" for i in range(204)]
        for place in rng.sample(range(5, 200, 6), 4):
            words[place] = f"own{k}x{place}"
        texts.append(" ".join(words))
    texts.append(texts[4] + " end")
    n_tried, verified = [], near_copies._verified

    def spy(pairs, sets):
        n_tried.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", spy)
    rows = list(enumerate(texts))
    assert stage_kept(spark, spark.createDataFrame(rows, "doc_id long, text string")) == sorted(plain_kept(rows))
    assert sum(n_tried) < 6 * len(texts), n_tried


def test_only_sets_of_candidates_are_joined(spark, monkeypatch):
    # pairs of texts that share 85 of 100 shingles, so that all have a set and none is similar, and 3 copies with another last word
    texts = [" ".join([f"s{k // 2}w{i}" for i in range(89)] + [f"own{k}x{i}" for i in range(15)]) for k in range(100)]
    texts += [texts[k] + " end" for k in (5, 50, 75)]
    given, verified = [], near_copies._verified

    def spy(pairs, sets):
        needed = {r[c] for r in pairs.collect() for c in ("u", "v")}
        given.append((len(needed), {r["rid"] for r in sets.select("rid").collect()}))
        assert needed <= given[-1][1]
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", spy)
    rows = list(enumerate(texts))
    assert stage_kept(spark, spark.createDataFrame(rows, "doc_id long, text string")) == sorted(plain_kept(rows)) == list(range(100))
    assert all(len(there) <= 2 * n + 10 for n, there in given), [(n, len(there)) for n, there in given]
