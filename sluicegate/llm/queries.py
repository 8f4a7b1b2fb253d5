"""Queries over the given tables, one per operator, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontaminate, embedding_links, license_scan, line_chunks, mixing, quality, secret_scan, simhash, spelling_variants, token_counts, token_files, toxicity
from .labelled import remainder
from .oracle import ORACLE_SQL as ORACLE_SQL

# Target shares of the mix: three named sources, and one share that all others divide by their rows.
SOURCE_WEIGHTS = {"src0": 0.25, "src1": 0.15, "src2": 0.1}
REST_WEIGHT = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _judged(judged: DataFrame, folds: int, held_out: int, threshold: float, *more: str) -> DataFrame:
    score: Column = F.col("judged.score")
    return judged.select(
        "doc_id",
        (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        *[f"judged.{c}" for c in more],
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.with_toxicity(docs, model, "judged")
    return _judged(judged, toxicity.FOLDS, toxicity.HELD_OUT, toxicity.THRESHOLD, "n_spans", "spans")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("notices")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs, *mixing.every_source(docs, SOURCE_WEIGHTS, REST_WEIGHT))


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_chunks.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("md5"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.assign(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("found")


def op7_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.linked(table(spark, sf_dir, "embeddings"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    return token_files.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path or word_tokenizer())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.with_quality(docs, model, "judged")
    return _judged(judged, quality.FOLDS, quality.HELD_OUT, quality.THRESHOLD, "n_lines", "n_bad_lines")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(*conversation_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path or byte_tokenizer())


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_license_scan,
        op3_mixing,
        op4_line_chunks,
        op5_simhash,
        op6_secret_scan,
        op7_embedding_links,
        op8_decontaminate,
        op9_token_files,
        op10_quality,
        op11_conversation_trie,
        op12_spelling_variants,
        op13_token_counts,
    )
}
