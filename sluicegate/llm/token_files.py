"""Token ids as ORC files.

Documents are ordered by range partitioning, so each file holds a run of the order and no task sees more
than its range. A file row has the document id, its file number, the tokens before it in that file, its
token count and its ids. ORC packs the ids by integer run-length encoding in stripes that tasks read side
by side; row indexes (an entry for each ``ROWS_PER_INDEX`` rows) and Bloom filters on ``doc_id`` let a
lookup of a few documents skip the rest. Global starts need one number per file: its token total.

A text is encoded by the tokenizer file's own rules. Under rules that drop white space and lower-case (those that
``parts_at_blanks`` knows), pieces between blanks are independent of each other, so a piece is encoded once and
then looked up; the stores have fixed sizes, which change the time and not the result. Under any other rules, and
under a sentencepiece model, the library encodes whole texts.

Nulls and empty texts give the end id alone. Rows that repeat a ``doc_id`` keep a row each, ordered by the
hash of their text; null ids come first. An empty table gives files without rows. Columns beyond ``doc_id``
and ``text`` are not written, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import working_folder

END_ID = 2
ROWS_PER_INDEX = 1000
BLOOM_FALSE_POSITIVES = 0.01
MAX_PIECES = 400_000
ROWS_PER_BATCH = 2000
FILE_SCHEMA = "doc_id bigint, part int, before bigint, n_tokens bigint, ids array<int>"
# The rules under which pieces between blanks are independent, and marks are parted from words.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_END = "</w>"
# A mark between a letter and a blank is a piece of its own under these rules.
TRAILING_MARK = re.compile(r"[,.](?<=[a-zà-öø-ÿ][,.])(?=[ \n])")


def parts_at_blanks(tokenizer_path: str) -> bool:
    """Whether a tokenizer file has the rules by which ``PieceEncoder`` cuts texts."""
    if not tokenizer_path.endswith(".json"):
        return False
    with open(tokenizer_path, encoding="utf-8") as file:
        rules = json.load(file)
    normalizer, parts = rules.get("normalizer") or {}, (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and parts[0].get("pattern") == {"Regex": WORD_PATTERN}
        and (parts[0].get("behavior"), parts[0].get("invert")) == ("Removed", True)
        and rules["model"].get("end_of_word_suffix") == WORD_END
        and all("<|" in token["content"] and " " not in token["content"] for token in rules.get("added_tokens", []))
    )


class WholeEncoder:
    """``texts -> ids`` as little-endian bytes, by the library of the tokenizer's file."""

    def __init__(self, tokenizer_path: str):
        if tokenizer_path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path)
            self._ids = lambda texts: processor.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(tokenizer_path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._ids = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def many(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self._ids(texts)]


class PieceEncoder:
    """``texts -> ids`` as little-endian bytes, with a bounded store of the pieces between blanks.

    The store has two generations: a full one becomes the old one, and pieces move on when they come again.
    """

    def __init__(self, tokenizer_path: str, max_pieces: int = MAX_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.max_pieces = max_pieces
        self.pieces: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; new pieces of all of them are encoded together."""
        split = [self._split(text) for text in texts]
        new = set().union(*split).difference(self.pieces)
        if new:
            self._learn(new)
        ids = [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in split]
        if len(self.pieces) > self.max_pieces:
            self.old, self.pieces = self.pieces, {}
        return ids

    def _split(self, text: str) -> list[str]:
        plain = text
        if "<|" not in text:  # special tokens are matched before the text is lower-cased
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                plain = TRAILING_MARK.sub(r" \g<0>", text.lower())
        return plain.replace("\n", " ").split(" ")

    def _learn(self, found: set[str]) -> None:
        back = found.intersection(self.old)
        self.pieces.update((p, self.old[p]) for p in back)
        new = found - back
        # A piece of letters is one pre-token, which ends in one id with an end mark: encode such as one text.
        words = [p for p in new if p.isalpha()]
        if words:
            (encoded,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(words):
                data, begin = ids.tobytes(), 0
                for word, end in zip(words, (ends * 4).tolist()):
                    self.pieces[word] = data[begin:end]
                    begin = end
                new.difference_update(words)
        rest = list(new)
        for piece, encoded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.pieces[piece] = np.array(encoded.ids, "<u4").tobytes()


def encoder_of(tokenizer_path: str) -> PieceEncoder | WholeEncoder:
    return PieceEncoder(tokenizer_path) if parts_at_blanks(tokenizer_path) else WholeEncoder(tokenizer_path)


def _encoder(tokenizer_path: str) -> PieceEncoder | WholeEncoder:
    """One encoder per Python worker, kept from task to task.

    Task functions arrive by value and have globals of their own, so the encoder is kept in ``sys.modules``.
    A worker has one task; threads of the library would each hold memory of their own.
    """
    kept = sys.modules.setdefault("_kept_encoders", ModuleType("_kept_encoders")).__dict__
    if tokenizer_path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept[tokenizer_path] = encoder_of(tokenizer_path)
    return kept[tokenizer_path]


def _encoded(tokenizer_path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in _slices(whole):
                data = [ids + end for ids in encoder.many([text or "" for text in batch.column("text").to_pylist()])]
                counts = np.fromiter((len(d) // 4 for d in data), np.int64, len(data))
                befores = before + np.concatenate(([0], np.cumsum(counts)))
                before = int(befores[-1])
                values = pa.array(np.frombuffer(b"".join(data), "<u4").view("<i4"))
                offsets = pa.array((befores - befores[0]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.full(len(data), part, np.int32)),
                        pa.array(befores[:-1]),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, values),
                    ],
                    ["doc_id", "part", "before", "n_tokens", "ids"],
                )

    return encode


def _slices(batch: pa.RecordBatch, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``max_bytes`` of text each, one row at least."""
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0), np.int64)
    group = (np.cumsum(sizes) - sizes) // max_bytes
    for start, stop in zip(*(lambda c: (c[:-1], c[1:]))(np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)])))):
        if stop > start:
            yield batch.slice(int(start), int(stop - start))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, order: list[Column] | None = None) -> None:
    """Write token files for ``docs`` at ``path``, in the order of ``order`` (``doc_id`` unless given)."""
    keys = order if order is not None else [F.col("doc_id")]
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
        *[k.alias(f"_k{i}") for i, k in enumerate([*keys, F.xxhash64(F.col("text"))])],
    )
    names = [c for c in keyed.columns if c.startswith("_k")]
    ordered = keyed.repartitionByRange(*names).sortWithinPartitions(*names).select("doc_id", "text")
    rows = ordered.mapInArrow(_encoded(tokenizer_path, end_id), FILE_SCHEMA)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").options(
        **{
            "compression": "zstd",
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": str(BLOOM_FALSE_POSITIVES),
            "orc.row.index.stride": str(ROWS_PER_INDEX),
        }
    )
    # Long texts come to the workers in small batches while this job runs.
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, ROWS_PER_BATCH)
    try:
        writer.orc(path)
    finally:
        conf.set(key, before)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of token files. A filter on ``doc_id`` reaches the row indexes and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values = np.asarray(ids.values).astype("<u4", copy=False)
        offsets = ids.offsets.to_pylist()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("doc_id", "part", "before")],
                pa.array(np.diff(np.array(offsets, np.int64))),
                pa.array(np.array(sums, np.int64)),
            ],
            ["doc_id", "part", "before", "n_tokens", "ids_crc32"],
        )


def summary(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    The broadcast side has one row per file.
    """
    totals = read(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    rows = read(spark, path).mapInArrow(_checksums, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, order: list[Column] | None = None) -> DataFrame:
    """Write ``docs`` as token files in the shared working folder and return their ``summary``."""
    path = working_folder(docs.sparkSession, "tokens")
    write(docs, path, tokenizer_path, end_id, order)
    return summary(docs.sparkSession, path)
