"""Every stage against a plain version, on what the stage before kept."""

from tokenizers import Tokenizer

import corpus_pipeline as P
from sluicegate.llm import mixing, quality
from sluicegate.llm.kept import keep
from sluicegate.llm.queries import REST_WEIGHT, SOURCE_WEIGHTS, word_tokenizer
from test_decontaminate import plain_matches
from test_near_copies import plain_kept

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near copies", "decontamination", "mixing", "token files"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outputs = [docs]
    for _, stage in P.STAGES:
        outputs.append(keep(stage(spark, outputs[-1], SF), "test-stage"))
    rows = [sorted(d.collect()) for d in outputs]
    assert all(d.columns == docs.columns for d in outputs[:-1])

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r["doc_id"] for r in rows[1]}
    judged = [(labels[r["doc_id"]], r["doc_id"] in good) for r in rows[0] if r["doc_id"] in labels]
    assert sum(bool(y) == kept for y, kept in judged) >= 0.95 * len(judged)
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality.with_quality(docs, model, "q").select("doc_id", "q.score").collect()
    assert good == {r["doc_id"] for r in scores if r["score"] >= quality.THRESHOLD}

    single = plain_kept([(r["doc_id"], r["text"]) for r in rows[1]])
    assert rows[2] == [r for r in rows[1] if r["doc_id"] in single] and len(single) < len(rows[1])

    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    leaking = {d for d, _ in plain_matches([(r["doc_id"], r["text"]) for r in rows[2]], items)}
    assert rows[3] == [r for r in rows[2] if r["doc_id"] not in leaking] and leaking

    assert rows[4] == rows[3]
    placed = mixing.mixed(outputs[3], *mixing.every_source(outputs[3], SOURCE_WEIGHTS, REST_WEIGHT)).orderBy("position").collect()
    library, start = Tokenizer.from_file(word_tokenizer()), 0
    by_start = sorted(rows[5], key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == [r["doc_id"] for r in placed]
    for want, r in zip(placed, by_start):
        n = len(library.encode(want["text"], add_special_tokens=False).ids) + 1
        assert (r["start"], r["n_tokens"]) == (start, n)
        start += n
    assert sorted(P.run(spark, SF).collect()) == rows[5]
