"""Held-out accuracy of the two classifiers, and the offsets of toxic words."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def auc(score, y):
    ranks = score.rank().to_numpy()
    ones = int(y.sum())
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize(
    ("query", "label", "least"), [(queries.op1_toxicity, "toxic", 0.9), (queries.op10_quality, "quality", 0.98)]
)
def test_held_out(spark, query, label, least):
    scored = query(spark, SF)
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(rows) > 50 and rows.score.between(0, 1).all()
    assert auc(rows.score, rows[label].to_numpy()) >= least
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (rows.predicted == rows[label]).mean() >= 0.9
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.curve, b.curve) and a.share == b.share


def test_toxic_offsets(spark):
    rows = [(i, f"some plain words {'you vile brute' if i % 2 else 'here'} and more é{i}", i % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    found = toxicity.with_toxicity(docs, model, "t").select("text", "toxic", "t.*").collect()
    for r in found:
        words = [r["text"][int(a) : int(b)] for a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert words == (["you", "vile", "brute"] if r["toxic"] else [])
        assert (r["score"] >= 0.3) == bool(r["toxic"]) and r["n_spans"] == len(words)
