"""Spelling variants: blocked Gram matrices of letter counts, and the edit itself to verify.

Words are counted over all texts by Spark with partial sums in every task. Two words are near if one inserted,
deleted or replaced code point parts them. Such words have equal or adjacent lengths, and cut in two halves they
agree on one half whole: a word of length L meets words of length L and L + 1 in the blocks (L, first half) and
(L, second half). In a block NumPy products of letter-count rows give all squared distances at once,
``|a|^2 + |b|^2 - 2ab``; a replaced letter gives at most 2 and an inserted one 1. Pairs at most 2 apart are kept
and verified on the words. A pair that agrees on both halves is taken from the first-half block only.

Blocks of a task lie side by side in strips of ``STRIP`` rows, so that small blocks share a product. A block of more
than ``TILE`` words is dealt as pairs of tiles, each a group of at most about ``2 * TILE`` words, so no task holds more
than a strip and a tile pair. Nothing but verified pairs leaves a block.

``n_near``, the largest near word and its count are aggregated with partial sums. Forms at least double the count, so
a chain of forms has at most log2 of the largest count links; doubling steps follow all chains together.

A null text has no words, a null ``doc_id`` counts as empty text in the hash of a run, and repeated rows count as
often as they stand. An empty table gives no words. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from .kept import keep

# Runs of letters, and the letters that are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIVISOR = 97
MIN_LENGTH, MIN_COUNT = 5, 3
MAX_SQUARED = 2
RATIO = 2
STRIP = 1024
TILE = 8192
BLOCK = "block"
PAIRS = "a string, n_a long, b string, n_b long"


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` over all texts; every ``DIVISOR``-th run by the hash of id and run loses one code point."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run"))
    place = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    spelled = runs.select(F.when(h % DIVISOR == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelled.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def postings(counted: DataFrame) -> DataFrame:
    """``block, word, n``: each word in the blocks of its own length and of the length below."""
    length = F.length("word")

    def entry(of_length, side):
        half = F.floor(of_length / 2).cast("int")
        part = F.substr("word", F.lit(1), half) if side == "<" else F.substr("word", length - of_length + half + 1)
        return F.concat_ws(" ", of_length.cast("string"), F.lit(side), part)

    blocks = F.array(*[entry(of_length, side) for of_length in (length, length - 1) for side in "<>"])
    return counted.select(F.explode(blocks).alias(BLOCK), "word", "n")


def dealt(posted: DataFrame, tile: int = TILE) -> DataFrame:
    """``posted`` with ``tiles``, the pair of tiles a row stands in, and ``side``: 0 both, 1 first, 2 second tile.

    Blocks of at most ``tile`` words are one group; a row of a larger block goes to every pair with its tile.
    """
    large = posted.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile)
    large = keep(large.select(BLOCK, F.ceil(F.col("size") / tile).cast("int").alias("n_tiles")), "large")
    found = lookup(posted, large, BLOCK, F.col("word"))
    own = F.pmod(F.xxhash64("word"), F.col("n_tiles")).cast("int").alias("own")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("n_tiles") - 1),
        lambda other: F.struct(
            F.concat_ws("-", F.least(F.col("own"), other).cast("string"), F.greatest(F.col("own"), other).cast("string")).alias("tiles"),
            F.when(other == F.col("own"), 0).when(F.col("own") < other, 1).otherwise(2).alias("side"),
        ),
    )
    alone = F.array(F.struct(F.lit("").alias("tiles"), F.lit(0).alias("side")))
    placed = found.select("*", own)
    return placed.select(BLOCK, "word", "n", F.explode(F.when(F.col("n_tiles").isNull(), alone).otherwise(pairs)).alias("p")).select(
        BLOCK, "p.tiles", "p.side", "word", "n"
    )


def is_edit(a: str, b: str) -> bool:
    """Whether one replaced or inserted code point turns ``a`` into ``b``, which is as long or one longer."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :]


def letter_counts(found: list[str]) -> np.ndarray:
    """One row of letter counts per word: a to z, then the letters from U+00C0."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    codes = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.int64)
    columns = np.where(codes >= 0xC0, codes - 0xC0 + 26, codes - ord("a"))
    counts = np.zeros((len(found), 90), np.float32)
    np.add.at(counts, (np.repeat(np.arange(len(found)), lengths), columns), 1)
    return counts


class _Strip:
    """Consecutive rows of one task, with what the Gram matrix and its masks need."""

    def __init__(self, rows: list[tuple], start: int, stop: int):
        self.start, part = start, rows[start:stop]
        self.groups = np.array([r[0] for r in part])
        self.of_length = np.array([int(r[1].split(" ", 1)[0]) for r in part])
        self.sides = np.array([r[2] for r in part])
        words = [r[3] for r in part]
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.counts = letter_counts(words)
        self.squares = (self.counts * self.counts).sum(1)

    def close_to(self, other: _Strip) -> np.ndarray:
        """Places (row, row of other) of one group, at most ``MAX_SQUARED`` apart, the first of the block's length."""
        squared = self.squares[:, None] + other.squares[None, :] - 2 * (self.counts @ other.counts.T)
        close = (squared <= MAX_SQUARED) & (self.groups[:, None] == other.groups[None, :])
        close &= (self.lengths == self.of_length)[:, None]
        # Words of one tile meet in the group of that tile alone, where all sides are 0.
        close &= (self.sides[:, None] != other.sides[None, :]) | (self.sides[:, None] == 0)
        return np.argwhere(close) + (self.start, other.start)


def _pairs_of(rows: list[tuple]) -> Iterator[tuple]:
    """Verified pairs among ``rows`` (group, block, side, word, n), sorted by group."""
    strips = [_Strip(rows, start, start + STRIP) for start in range(0, len(rows), STRIP)]
    for one in strips:
        for other in strips:
            if other.groups[-1] < one.groups[0] or one.groups[-1] < other.groups[0]:
                continue
            for i, j in one.close_to(other).tolist():
                _, block, _, a, n_a = rows[i]
                _, _, _, b, n_b = rows[j]
                if len(a) == len(b) and a >= b or not is_edit(a, b):
                    continue
                half = len(a) // 2
                if block.split(" ", 2)[1] == ">" and a[:half] == b[:half]:
                    continue
                yield a, n_a, b, n_b


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified pairs of rows sorted by group; whole groups are worked on together, a strip or more at a time."""

    def pairs() -> pa.RecordBatch:
        found = list(_pairs_of(rows))
        return pa.RecordBatch.from_pydict(
            {c: pa.array([pair[k] for pair in found], kind) for k, (c, kind) in enumerate((("a", pa.string()), ("n_a", pa.int64()), ("b", pa.string()), ("n_b", pa.int64())))}
        )

    rows, group, number = [], None, 0
    for batch in batches:
        for block, tiles, side, word, n in zip(*(batch.column(c).to_pylist() for c in (BLOCK, "tiles", "side", "word", "n"))):
            if (block, tiles) != group:
                if len(rows) >= STRIP:
                    yield pairs()
                    rows = []
                group, number = (block, tiles), number + 1
            rows.append((number, block, side, word, n))
    if rows:
        yield pairs()


def near_pairs(counted: DataFrame, tile: int = TILE) -> DataFrame:
    """``a, n_a, b, n_b``: every two near words of ``counted`` once."""
    posted = keep(postings(counted), "postings")
    grouped = dealt(posted, tile).repartition(BLOCK, "tiles").sortWithinPartitions(BLOCK, "tiles")
    return grouped.mapInArrow(_paired, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word with a form; ``forms``: word, form."""
    at = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = keep(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, tile: int = TILE) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every frequent word, its form and the last form of its chain."""
    counted = keep(words(docs, min_length, min_count), "words")
    pairs = keep(near_pairs(counted, tile), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    # The largest count, and of those the word that is first in code-point order.
    best = F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("b").alias("form"))).alias("best")
    near = both.groupBy(F.col("a").alias("word"), F.col("n_a").alias("n")).agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.minus") >= RATIO * F.col("n")
    near = near.select("word", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n"))
    near = keep(near, "near")
    found = near.join(roots(near.where("form IS NOT NULL").select("word", "form")), "word", "left")
    return counted.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
