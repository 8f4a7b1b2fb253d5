"""Phrases are a parameter of the license scan: they need not hold the word license."""

from sluicegate.llm import license_scan


def test_phrases_without_the_word_license(spark):
    texts = ["Under the BSD clause, and the bsd-clause.", "a clause alone", "MIT License", "ÉTÉ of K bsd clause", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = license_scan.scan(docs, phrases=[("bsd", "bsd clause"), ("mit", "mit license")]).collect()
    assert [(r["n_base"], r["base_labels"]) for r in sorted(found)] == [(2, "bsd"), (0, ""), (1, "mit"), (1, "bsd"), (0, "")]
