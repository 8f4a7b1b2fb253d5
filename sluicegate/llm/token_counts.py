"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

A pre-token here is what stands between two blanks, with the blank before it. Under the tokenizers that
``CutsAtBlanks`` accepts, no merge crosses such a place, so a text's count is the sum over its pre-tokens.

First tier: the most frequent pre-tokens of all documents with their lengths, broadcast as one hash table of at
most ``TABLE_ROWS`` keys of at most ``MAX_KEY_CHARS`` characters. They are found by a mergeable sketch
(``approx_top_k``): every task sends a summary of at most ``SKETCH_ITEMS`` items, and no pre-token is shuffled.
Second tier: a store in each Python worker, of bounded size, for what the table lacks; only what neither
holds is encoded. Both tiers change the time and never the count. A worker has one task, so the library gets no
threads in it: each would hold memory of its own.

Texts that may not be cut go to the library whole: those that hold an added token's string, and those with a
blank between two white-space characters. So do all texts under a tokenizer that ``CutsAtBlanks`` does not accept.

Nulls count as empty: no bytes, no tokens. Repeated rows keep a row each, null ids pass, an empty table gives no
rows, and columns beyond ``text`` pass untouched, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import free_names

LIMIT = 512
TABLE_ROWS = 32_768
SKETCH_ITEMS = 98_304
SKETCH_SHARDS = 16
MAX_KEY_CHARS = 32
STORED_PIECES = 100_000
CHARS_AT_ONCE = 1 << 18
# Fixed value: how byte-level vocabularies write a blank.
BLANK = "\u0120"
# A blank whose place in a run of white space decides the cut; Python's white space holds all of the library's.
WHITE = re.compile(r"\s")
INSIDE_A_RUN = re.compile(r"\s \s")


class WholeTexts:
    """Counts of whole texts by the library of the tokenizer's file."""

    def __init__(self, tokenizer_path: str):
        if tokenizer_path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path)
            self._encode = lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(tokenizer_path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            vocabulary = tokenizer.get_vocab(with_added_tokens=True)
            self.tokenizer, self.begins = tokenizer, np.zeros(max(vocabulary.values()) + 1, bool)
            self.begins[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
            self._encode = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def many(self, texts: Iterable[str]) -> list[int]:
        texts = list(texts)
        return self._encode(texts) if texts else []

    def after_blanks(self, pieces: set[str]) -> dict[str, int]:
        """The length of each pre-token with a blank before it, for tokenizers that may be cut at blanks.

        Those without white space are encoded as one text, in which a token that begins with a blank begins a piece.
        """
        plain = [p for p in pieces if p and not WHITE.search(p)]
        odd = list(pieces.difference(plain))
        lengths = dict(zip(odd, self.many(" " + p for p in odd)))
        if plain:
            ids = np.array(self.tokenizer.encode("".join([" " + p for p in plain]), add_special_tokens=False).ids)
            starts = np.flatnonzero(self.begins[ids])
            lengths.update(zip(plain, np.diff(starts, append=len(ids)).tolist()))
        return lengths


class CutsAtBlanks:
    """Whether, and which, texts may be cut before their blanks under a tokenizer file's rules.

    Accepted are byte-level rules without normalizer, whose pattern lets a blank begin a piece and never end one
    unless white space stands before it.
    """

    def __init__(self, tokenizer_path: str):
        self.accepted, self.whole_only = False, None
        if tokenizer_path.endswith(".json"):
            with open(tokenizer_path, encoding="utf-8") as file:
                rules = json.load(file)
            split = rules.get("pre_tokenizer") or {}
            self.accepted = (
                rules.get("normalizer") is None
                and split.get("type") == "ByteLevel"
                and split.get("use_regex", True)
                and not split.get("add_prefix_space")
            )
            added = [token["content"] for token in rules.get("added_tokens", [])]
            self.whole_only = re.compile("|".join([INSIDE_A_RUN.pattern, *map(re.escape, added)]))

    def allowed(self, text: str) -> bool:
        return self.accepted and not self.whole_only.search(text)


class TokenCounter:
    """``texts -> counts`` through the table of frequent pre-tokens, the store, and the library.

    The store has two generations: a full one becomes the old one, and pre-tokens move on when they come again.
    """

    def __init__(self, tokenizer_path: str, frequent: dict[str, int] | None = None, stored_pieces: int = STORED_PIECES):
        self.library, self.cuts = WholeTexts(tokenizer_path), CutsAtBlanks(tokenizer_path)
        self.frequent, self.stored_pieces = frequent or {}, stored_pieces
        self.stored: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def many(self, texts: Iterable[str]) -> list[int]:
        texts = list(texts)
        counts, missing, whole = [0] * len(texts), {}, {}
        for i, text in enumerate(texts):
            if not self.cuts.allowed(text):
                whole[i] = text
                continue
            first, *rest = text.split(" ")
            found = list(map(self.frequent.get, rest))
            if None in found:
                missing[i] = [piece for piece, n in zip(rest, found) if n is None]
            counts[i] = sum(filter(None, found))
            if first:
                whole[i] = first
        lengths = self._lengths(set().union(*missing.values()))
        for i, pieces in missing.items():
            counts[i] += sum(map(lengths.__getitem__, pieces))
        for i, n in zip(whole, self.library.many(whole.values())):
            counts[i] += n
        return counts

    def _lengths(self, wanted: set[str]) -> dict[str, int]:
        found = {p: self.stored[p] for p in self.stored.keys() & wanted}
        if self.old:
            found.update((p, self.old[p]) for p in self.old.keys() & (wanted - found.keys()))
        found.update(self.library.after_blanks(wanted - found.keys()))
        self.stored.update((p, n) for p, n in found.items() if len(p) <= MAX_KEY_CHARS)
        if len(self.stored) > self.stored_pieces:
            self.old, self.stored = self.stored, {}
        return found


def frequent_pieces(docs: DataFrame) -> list[str]:
    """At most ``TABLE_ROWS`` pre-tokens that are frequent over all texts."""
    pieces = docs.select(F.explode(F.split(F.col("text").cast("string"), " ", -1)).alias("piece"))
    short = pieces.where(F.length("piece") <= MAX_KEY_CHARS)
    shard = F.spark_partition_id() % SKETCH_SHARDS
    sketches = short.groupBy(shard.alias("shard")).agg(F.expr(f"approx_top_k_accumulate(piece, {SKETCH_ITEMS})").alias("sketch"))
    # Grouped, so that no rows give no sketch.
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"))
    row = merged.select(F.expr(f"approx_top_k_estimate(sketch, {TABLE_ROWS})").alias("top")).select("top.item").first()
    return [] if row is None or row[0] is None else [item for item in row[0] if item is not None]


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``CHARS_AT_ONCE`` bytes, one text at least."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= CHARS_AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def with_token_counts(docs: DataFrame, tokenizer_path: str, name: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of ``text``, without begin, end or added special tokens."""
    frequent: dict[str, int] = {}
    if CutsAtBlanks(tokenizer_path).accepted:
        pieces = frequent_pieces(docs)
        frequent = WholeTexts(tokenizer_path).after_blanks(set(pieces))
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    key = uuid.uuid4().hex

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        # One counter per Python worker. Task functions arrive by value and have globals of their own.
        kept = sys.modules.setdefault("_kept_counters", ModuleType("_kept_counters")).__dict__
        if kept.get("key") != key:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            kept.update(key=key, counter=TokenCounter(tokenizer_path, table.value))
        return pa.array([n for run in _slices(texts) for n in kept["counter"].many(run)], pa.int64())

    return docs.withColumn(name, count(F.col("text").cast("string")))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, bytes and tokens of each text, and whether it has more than ``limit`` tokens."""
    (name,) = free_names(docs, "n_tokens")
    counted = with_token_counts(docs.select("doc_id", "text"), tokenizer_path, name)
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), F.col(name).alias("n_tokens"), (F.col(name) > limit).alias("over_limit"))
