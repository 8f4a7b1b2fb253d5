"""Token files against the library, text by text."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluicegate.llm import token_files
from sluicegate.llm.queries import word_tokenizer

ODD = [
    "don't <|endoftext|> A<|ENDOFTEXT|>b <|startoftext|>",
    "É é é ́x,. y, z. \n. a.. b,c 'S it's 12ab ΑΣ Σ İ K\xa0x\x85y\tq  r\r\n\x1cz   µª ﬁ",
    "",
    ".",
    "a.\n\nb, 'll x''s naïve, ß. ÿ, ",
    "MIXED Case. Words, words. words,words 中文 字,。 😀😀, á, ́b",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_tokenizer())


@pytest.mark.parametrize("kept", [2, 1000])
def test_encoder(library, kept):
    encoder = token_files.PieceEncoder(word_tokenizer(), kept)
    for texts in (ODD, ODD[::-1], [t.upper() for t in ODD], [f"{t} {t}" for t in ODD]):
        ids = [np.frombuffer(found, "<u4").tolist() for found in encoder.many(texts)]
        assert ids == [library.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("kept", [5, 2000])
def test_random_texts(library, kept):
    rng, encoder = random.Random(kept), token_files.PieceEncoder(word_tokenizer(), kept)
    letters = " \n\t,.aBéÀßÿµª×÷İ1'sſK語\u0301\xa0\x85<|"
    for _ in range(30):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) for _ in range(100)]
        ids = [np.frombuffer(found, "<u4").tolist() for found in encoder.many(texts)]
        assert ids == [library.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_rules_encode_whole_texts(spark, root, name):
    path = public_tokenizers.path(name)
    texts = ["Hello big world, again.", "  Two  blanks.\nÉ 語 ", "", *ODD]
    encoder = token_files.encoder_of(path)
    assert isinstance(encoder, token_files.WholeEncoder) and token_files.parts_at_blanks(word_tokenizer())
    if name.endswith(".json"):
        want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    else:
        import sentencepiece

        want = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write(docs, f"{root}/tokens", path)
    found = {r["doc_id"]: r["ids"] for r in token_files.read(spark, f"{root}/tokens").collect()}
    assert found == {i: [*ids, 2] for i, ids in enumerate(want)}


def test_round_trip(spark, library, root):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    token_files.write(docs, f"{root}/tokens", word_tokenizer())
    found = sorted(token_files.summary(spark, f"{root}/tokens").collect())
    start = 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [r["doc_id"] for r in found] == sorted(texts)
    for row in found:
        ids = [*library.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    one = token_files.read(spark, f"{root}/tokens").where("doc_id = 17")
    assert one.first()["ids"] == [*library.encode(texts[17], add_special_tokens=False).ids, 2]
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().toString()
