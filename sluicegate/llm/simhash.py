"""Near copies by SimHash, through an inverted index over byte positions.

A fingerprint is 64 bits from the word shingles of a text. Two fingerprints within ``MAX_BITS`` = 3 bits
differ in at most 3 of their 8 bytes, so they share at least 5 positional bytes. A posting is a set of four
positional bytes: the 14 blocks of the Steiner system S(3,4,8) are chosen so that any 3 differing bytes
leave a whole block untouched. Each pair is tallied where its first shared block stands, kept when its
tally of shared positional bytes reaches 5, and verified by its differing bits. A posting list needs 32
equal bits, so lists stay short where single-byte lists would hold a 256th of all fingerprints each.

Copies share a fingerprint and enter the index once, however many there are. Components come from links
between different fingerprints; documents get theirs by a join on the fingerprint, which Spark splits for
a frequent one.

Nulls and empty texts have fingerprint zero and are linked like any other. A null ``doc_id`` keeps its row
but never names a component that holds another id. Repeated rows keep a row each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .kept import free_names, keep

SHINGLE = 3
SEED = 42
MAX_BITS = 3
MIN_SHARED = 5
WORDS_AT_ONCE = 1 << 17


def steiner_blocks() -> list[tuple[int, ...]]:
    """Blocks of S(3,4,8): the sets of four numbers from 0 to 7 whose exclusive-or is zero."""
    return [b for b in combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]


BLOCKS = steiner_blocks()


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint; zero for a text without words."""
    import xxhash

    # On bytes, lower() and split() know ASCII only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles_at = [[b" ".join(words)]]
    else:
        shingles_at = (
            map(b" ".join, zip(*(words[i + j : i + j + WORDS_AT_ONCE] for j in range(size - 1)), words[i + size - 1 : i + size - 1 + WORDS_AT_ONCE]))
            for i in range(0, len(words) - size + 1, WORDS_AT_ONCE)
        )
    ones, total = np.zeros(64, np.int64), 0
    for shingles in shingles_at:
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, name: str, size: int = SHINGLE) -> DataFrame:
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), size) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, fingerprints(F.col("text").cast("string")))


def _mask(block: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * i) for i in block) - (1 << 64 if 7 in block else 0)


def _shared_bytes(differing: Column) -> Column:
    equal = [F.when(F.shiftrightunsigned(differing, 8 * i).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for i in range(8)]
    return sum(equal[1:], equal[0])


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (``fp``) to pairs (u, v) of different ones within ``MAX_BITS`` bits, each once."""
    postings = prints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(b))) for b in BLOCKS])).alias("block", "four")
    )
    left = postings.select(F.col("fp").alias("u"), "block", "four")
    right = postings.select(F.col("fp").alias("v"), "block", "four")
    differing = F.col("u").bitwiseXOR(F.col("v"))
    first = F.when(differing.bitwiseAND(F.lit(_mask(BLOCKS[0]))) == 0, 0)
    for number, block in enumerate(BLOCKS[1:], 1):
        first = first.when(differing.bitwiseAND(F.lit(_mask(block))) == 0, number)
    tallied = (F.col("u") < F.col("v")) & (_shared_bytes(differing) >= MIN_SHARED)
    verified = (F.bit_count(differing) <= MAX_BITS) & (first == F.col("block"))
    return left.join(right, ["block", "four"]).where(tallied & verified).select("u", "v")


def classes(printed: DataFrame, fp: str) -> DataFrame:
    """One row per fingerprint: ``fp``, ``root`` (least linked fingerprint), for rows of ``printed``."""
    prints = keep(printed.select(F.col(fp).alias("fp")).distinct(), "prints")
    linked = components(links(prints))
    return prints.join(linked, prints["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def assign(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id`` (least ``doc_id`` of its component)."""
    printed = keep(with_fingerprint(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "fingerprints")
    found = classes(printed, "fp")
    least = printed.groupBy("fp").agg(F.min("doc_id").alias("least")).join(found, "fp")
    by_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(by_root, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return printed.join(named, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one with the least ``doc_id``, of repeated rows any one.

    A component without any ``doc_id`` keeps one row too.
    """
    fp, rid = free_names(docs, "fp", "rid")
    staged = keep(with_fingerprint(docs, fp).withColumn(rid, F.monotonically_increasing_id()), "fingerprinted")
    found = classes(staged, fp)
    thin = staged.select(F.struct(F.col("doc_id").isNull(), "doc_id", rid).alias("rank"), F.col(fp).alias("fp"))
    firsts = thin.groupBy("fp").agg(F.min("rank").alias("rank")).join(found, "fp").groupBy("root").agg(F.min("rank").alias("rank"))
    return staged.join(firsts.select(F.col(f"rank.{rid}").alias(rid)), rid, "left_semi").select(*docs.columns)
