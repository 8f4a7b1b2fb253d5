"""The corpus pipeline: quality, near copies, benchmark leaks, mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept. Between stages
documents are written as Parquet and read again. The mix is carried by the order of files and of rows in
them, which the last stage follows: its token files hold the documents in mixed order.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.llm import decontaminate, mixing, near_copies, quality, token_files
from sluicegate.llm.kept import free_names, keep
from sluicegate.llm.queries import REST_WEIGHT, SOURCE_WEIGHTS, table, word_tokenizer


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    (name,) = free_names(docs, "judged")
    judged = quality.with_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")), name)
    return judged.where(F.col(name).getField("score") >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a Jaccard similarity of 0.8."""
    return near_copies.one_of_each(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.in_mixed_order(docs, *mixing.every_source(docs, SOURCE_WEIGHTS, REST_WEIGHT))


def stored_order(docs: DataFrame) -> list[Column] | None:
    """Columns that give the order in which files hold ``docs``, or None when it does not come from files."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(name, row)
    except AnalysisException:
        return None
    return [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, row]


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the stored order, and one row per document of them."""
    return token_files.encode_documents(docs, word_tokenizer(), order=stored_order(docs))


STAGES = [
    ("quality", keep_good),
    ("near copies", keep_one_of_each),
    ("decontamination", keep_unseen),
    ("mixing", mix),
    ("token files", to_tokens),
]

# A trained classifier, fingerprints and a tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = keep(docs, "stage")
    return docs
