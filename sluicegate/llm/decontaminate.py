"""Benchmark leaks: every training passage queries a BM25 index of the test items, with block-max pruning.

Each passage of a text is a query of its distinct words. An item must reach ``MIN_SCORE`` of the score it
gives itself, so impacts are stored divided by that and 1 is the threshold everywhere. As in block-max
WAND, upper bounds are tried from cheap to exact: the sum of the largest impacts of a text's words, then
the sum of the largest impacts per block of items for each passage, then the scores inside the blocks that
can still reach the threshold. All items at or above it are retrieved, and verified by the share of their
question's and answer's word shingles that stand in the passage (the last sentence is the answer).

Texts are cut into strides as long as the longest item, and a passage is two strides, so an item always
lies whole in some passage. The index that tasks hold is bounded by ``SHARD_BYTES`` of item text; a larger
benchmark is searched in shards, with counts taken over all items. No passage is left out.

Nulls, empty texts and items without words match nothing. Items of equal text are one item, named by the
least id. Repeated rows are searched one by one. An empty benchmark matches nothing. Other columns pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import free_names

MIN_SCORE = 0.6
MIN_OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 8
SHARD_BYTES = 16 << 20
WORDS_AT_ONCE = 200_000
CELLS_AT_ONCE = 2_000_000
NEAR = 1e-9
SENTENCE_END = re.compile(r"[.!?]+\s+|\n+")
# Words are runs of letters, lower-cased, digits and all bytes beyond ASCII.
FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of all sentences but the last, and of the last; an item of one sentence is all question."""
    parts = [w for w in (words_of(p) for p in SENTENCE_END.split(text)) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def shingles(ids: list[int], size: int = SHINGLE) -> set[tuple[int, ...]]:
    if len(ids) < size:
        return {tuple(ids)} if ids else set()
    return set(zip(*(ids[i:] for i in range(size))))


@dataclass
class Index:
    """Postings by term (rows of ``item``, ``impact`` from ``begin[term]`` on), and block maxima alike."""

    ids: list[int | None]
    terms: dict[bytes, int]
    begin: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    block_begin: np.ndarray
    block: np.ndarray
    block_max: np.ndarray
    most: np.ndarray
    question: list[set[tuple[int, ...]]]
    answer: list[set[tuple[int, ...]]]
    sizes: list[tuple[int, ...]]
    stride: int

    @property
    def n_blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)


def build(items: list[tuple[int | None, str, dict[bytes, int]]], n_items: int, mean_length: float) -> Index:
    """``items``: id, text, and for each word of it the number of all items that hold it."""
    terms: dict[bytes, int] = {}
    rows, lengths, question, answer, sizes = [], [], [], [], []
    for number, (_, text, holding) in enumerate(items):
        words = words_of(text)
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
            terms.setdefault(w, len(terms))
        norm = K1 * (1 - B + B * len(words) / mean_length)
        impacts = {
            w: np.log1p((n_items - holding[w] + 0.5) / (holding[w] + 0.5)) * c * (K1 + 1) / (c + norm) for w, c in counts.items()
        }
        needed = MIN_SCORE * sum(impacts.values())
        rows += [(terms[w], number, v / needed) for w, v in impacts.items()]
        q, a = question_and_answer(text)
        question.append(shingles([terms[w] for w in q]))
        answer.append(shingles([terms[w] for w in a]))
        sizes.append(tuple({len(p) for p in (q, a) if 0 < len(p) < SHINGLE}))
        lengths.append(len(words))
    rows.sort()
    term, item = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    impact = np.array([r[2] for r in rows])
    at = np.arange(len(terms) + 1)
    change = np.flatnonzero(np.diff(term * len(items) + item // BLOCK, prepend=-1))
    block_max = np.maximum.reduceat(impact, change)
    return Index(
        [i[0] for i in items],
        terms,
        np.searchsorted(term, at),
        item,
        impact,
        np.searchsorted(term[change], at),
        item[change] // BLOCK,
        block_max,
        np.maximum.reduceat(impact, np.searchsorted(term, at[:-1])),
        question,
        answer,
        sizes,
        max(lengths),
    )


def _spread(begin: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each posting of each of ``terms``: which of them it is of, and its row."""
    counts = begin[terms + 1] - begin[terms]
    of = np.repeat(np.arange(len(terms)), counts)
    within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of, begin[terms][of] + within


class Search:
    def __init__(self, index: Index):
        self.index = index

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.index.terms.get, words, repeat(-1)), np.int32, len(words))

    def texts(self, many: list[np.ndarray]) -> list[dict[int, tuple[float, float, float]]]:
        """For each text (term numbers): item to score, question overlap, answer overlap."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in many]
        for text, start, item, score in self._retrieved(many):
            if score > found[text].get(item, (0.0,))[0]:
                verified = self._verify(many[text][start : start + 2 * self.index.stride], item)
                if verified:
                    found[text][item] = (score, *verified)
        return found

    def _retrieved(self, many: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """Text, start, item and score of every passage and item at or above the threshold."""
        x = self.index
        lengths = np.array([len(m) for m in many])
        if not lengths.sum():
            return
        ids = np.concatenate(many)
        text_of = np.repeat(np.arange(len(many)), lengths)
        begins = np.cumsum(lengths) - lengths
        hopeful = np.bincount(text_of, np.append(x.most, 0.0)[ids], len(many)) >= 1
        strides = np.where(hopeful, -(-lengths // x.stride), 0)
        before = np.cumsum(strides) - strides
        n_strides, n_terms = int(strides.sum()), len(x.most)
        on = np.flatnonzero(hopeful[text_of] & (ids >= 0))
        place = (on - begins[text_of[on]]) // x.stride
        key = np.unique((before[text_of[on]] + place) * n_terms + ids[on])
        stride_of, term = key // n_terms, key % n_terms
        text_of_stride = np.repeat(np.arange(len(many)), strides)
        step = max(2, CELLS_AT_ONCE // max(x.n_blocks, len(x.ids)))
        for low in range(0, n_strides, step - 1):
            high = min(low + step, n_strides)
            part = slice(*np.searchsorted(stride_of, (low, high)))
            follows = np.append(text_of_stride[low + 1 : high] == text_of_stride[low : high - 1], False)
            if high < n_strides:  # the last stride comes again, with the one after it
                follows[-1] = False
            passages, blocks = self._bounded(stride_of[part] - low, term[part], follows)
            if high < n_strides:
                inside = passages < high - low - 1
                passages, blocks = passages[inside], blocks[inside]
            for passage, item, score in self._scored(passages, blocks, stride_of[part] - low, term[part], follows):
                text = text_of_stride[low + passage]
                yield int(text), int((low + passage - before[text]) * x.stride), int(item), float(score * MIN_SCORE)

    def _bounded(self, stride_of: np.ndarray, term: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages (by their first stride) and blocks of items whose bound reaches 1."""
        x, n = self.index, len(follows)
        # Words of many blocks weigh little; their largest impact stands in for all blocks.
        everywhere = (x.block_begin[1:] - x.block_begin[:-1])[term] * 2 > x.n_blocks
        base = np.bincount(stride_of[everywhere], x.most[term[everywhere]], n)
        of, row = _spread(x.block_begin, term[~everywhere])
        cells = stride_of[~everywhere][of] * x.n_blocks + x.block[row]
        bound = np.bincount(cells, x.block_max[row], n * x.n_blocks).reshape(n, x.n_blocks) + base[:, None]
        bound[:-1] += bound[1:] * follows[:-1, None]
        return np.nonzero(bound >= 1 - NEAR)

    def _scored(
        self, passages: np.ndarray, blocks: np.ndarray, stride_of: np.ndarray, term: np.ndarray, follows: np.ndarray
    ) -> Iterator[tuple[int, int, float]]:
        """Exact scores inside the blocks left; a word counts once in a passage."""
        x = self.index
        if not len(passages):
            return
        chosen = np.unique(passages)
        starts = np.searchsorted(stride_of, np.arange(len(follows) + 1))
        firsts, of_first = _spread(starts, chosen)
        after = np.flatnonzero(follows[chosen])
        seconds, of_second = _spread(starts, chosen[after] + 1)
        key = np.unique(np.concatenate((firsts * len(x.most) + term[of_first], after[seconds] * len(x.most) + term[of_second])))
        of, row = _spread(x.begin, key % len(x.most))
        cells = (key // len(x.most))[of] * len(x.ids) + x.item[row]
        total = np.bincount(cells, x.impact[row], len(chosen) * len(x.ids)).reshape(len(chosen), -1)
        left = np.zeros((len(chosen), x.n_blocks), bool)
        left[np.searchsorted(chosen, passages), blocks] = True
        which, item = np.nonzero(total >= 1 - NEAR)
        ok = left[which, item // BLOCK]
        yield from zip(chosen[which[ok]].tolist(), item[ok].tolist(), total[which[ok], item[ok]].tolist())

    def _verify(self, ids: np.ndarray, item: int) -> tuple[float, float] | None:
        x, listed = self.index, ids.tolist()
        q, a = x.question[item], x.answer[item]
        here = shingles(listed)
        for size in x.sizes[item]:
            here |= shingles(listed, size)
        in_q, in_a = len(q & here), len(a & here)
        if in_q + in_a < MIN_OVERLAP * (len(q) + len(a)):
            return None
        return in_q / max(1, len(q)), in_a / max(1, len(a))


def indexes(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[Index]:
    """Indexes that together hold all items; each from at most about ``shard_bytes`` of text."""

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([[w.decode() for w in words_of(t.as_py())] for t in texts], pa.list_(pa.string()))

    items = (
        benchmark.where(F.col("text").isNotNull())
        .groupBy("text")
        .agg(F.min("item_id").cast("long").alias("item_id"))
        .withColumn("words", split("text"))
        .where(F.size("words") > 0)
    )
    n_items, mean_length, size = items.agg(
        F.count(F.lit(1)), F.avg(F.size("words")), F.sum(F.octet_length("text"))
    ).first()
    if not n_items:
        return []
    shards = -(-size // shard_bytes)
    words = items.select("text", "item_id", F.explode(F.array_distinct("words")).alias("word"))
    holding = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    whole = (
        words.join(holding, "word")
        .groupBy("text", "item_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("holding"))
        .withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)))
    )
    found = []
    for shard in range(shards):
        rows = whole.where(F.col("shard") == shard).orderBy("item_id", "text").collect()
        if rows:
            found.append(build([(r["item_id"], r["text"], {w.encode(): n for w, n in r["holding"].items()}) for r in rows], n_items, mean_length))
    return found


MATCH = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """``docs`` with an array column ``name`` of the benchmark items that each text holds."""
    kind = pa.list_(
        pa.struct(
            [("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]
        )
    )

    def searcher(index: Index):
        @F.arrow_udf(MATCH)
        def search(texts: pa.Array) -> pa.Array:
            engine, out = Search(index), []

            def flush(waiting: list[np.ndarray]) -> None:
                for matches in engine.texts(waiting):
                    out.append([(index.ids[i], *m) for i, m in sorted(matches.items())])

            waiting, held = [], 0
            for text in texts:
                waiting.append(engine.numbers(text.as_py()))
                held += len(waiting[-1])
                if held >= WORDS_AT_ONCE:
                    flush(waiting)
                    waiting, held = [], 0
            if waiting:
                flush(waiting)
            fields = ("item_id", "score", "question_overlap", "answer_overlap")
            return pa.array([[dict(zip(fields, m)) for m in ms] for ms in out], kind)

        return search

    found = [searcher(index)(F.col("text").cast("string")) for index in indexes(benchmark)]
    if not found:
        return docs.withColumn(name, F.array().cast(MATCH))
    return docs.withColumn(name, F.concat(*found))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per text and benchmark item that it holds."""
    with_found = with_leaks(docs.select("doc_id", "text"), benchmark, "found").select("doc_id", "found")
    return with_found.select("doc_id", F.inline("found"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    (name,) = free_names(docs, "found")
    return with_leaks(docs, benchmark, name).where(F.size(name) == 0).select(*docs.columns)
