"""Token counts against the library, text by text, for every kind of tokenizer file."""

import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import token_counts
from sluicegate.llm.queries import byte_tokenizer, op13_token_counts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
ODD = [
    "", " ", "  ", "   ", "a  b", "a   b", "a\n  b", "a \n b", " a", "a  ", "a \n", "\n a", "x\t y", "don't  's 's",
    "<|endoftext|> a", "a <|endoftext|>b", "1 2  3 4", "\x1c \x1c a", "a \x85 b", "日本 語 ", "é é ́x", "😀 😀", "a\xa0 b  c",
]


def plain_counts(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(processor.encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("stored", [3, 10_000])
def test_random_texts(stored):
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice(" \n\ta1.'s  é語") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    path = byte_tokenizer()
    frequent = token_counts.WholeTexts(path).after_blanks({"a", "", "s", "a1", "'s", "\n", "é."})
    counter = token_counts.TokenCounter(path, frequent, stored)
    for i in range(0, len(texts), 100):
        assert counter.many(texts[i : i + 100]) == plain_counts(path, texts[i : i + 100])
    assert sum(map(counter.cuts.allowed, texts)) > len(texts) / 2


def test_only_byte_level_rules_are_cut():
    accepted = {name: token_counts.CutsAtBlanks(public_tokenizers.path(name)).accepted for name in FILES}
    assert accepted == {"byte_bpe_50k.json": True, "word_bpe_49k.json": False, "piece_bpe_32k.model": False}


@pytest.mark.parametrize("name", FILES)
def test_query(spark, sf_dir, name):
    path = public_tokenizers.path(name)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in op13_token_counts(spark, sf_dir, path).collect()}
    assert sorted(found) == sorted(texts)
    for (i, text), n in zip(texts.items(), plain_counts(path, texts.values())):
        assert tuple(found[i]) == (i, len(text.encode()), n, n > 512)


def test_edges(spark):
    long = "a very long text of plain words. " * 50_000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "x"), (4, "<|endoftext|>"), (5, "y" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("n_tokens", "n_bytes", "piece", "shard")})
    path = byte_tokenizer()
    found = token_counts.token_counts(docs, path)
    want = [(i, len((t or "").encode()), n) for (i, t), n in zip(rows, plain_counts(path, [t or "" for _, t in rows]))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:3]) for r in found.collect())
    assert token_counts.token_counts(docs.limit(0), path).count() == 0
    assert token_counts.with_token_counts(docs, path, "n").columns == [*docs.columns, "n"]


def test_table_of_frequent_pieces_without_a_shuffle_of_pieces(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "common word").otherwise(F.concat(F.lit("rare "), "id")).alias("text"))
    assert {"common", "word", "rare"} <= set(token_counts.frequent_pieces(docs.repartition(7)))
    assert len(token_counts.frequent_pieces(docs)) <= token_counts.TABLE_ROWS


GROWTH = """
import resource
from sluicegate.llm import token_counts
from sluicegate.llm.queries import byte_tokenizer

counter = token_counts.TokenCounter(byte_tokenizer())
counter.many(["some words to begin with"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for k in range(50):
    counter.many([" ".join(f"w{k}q{j}x{i}" for i in range(180)) for j in range(100)])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


def test_memory_of_a_worker_that_meets_new_words_only():
    # 900,000 words, none of them twice
    root = Path(__file__).resolve().parents[2]
    grown = subprocess.run([sys.executable, "-c", GROWTH], cwd=root, capture_output=True, text=True, check=True).stdout
    assert int(grown) < 75_000  # KB; 102,000 with stores of 400,000 words
