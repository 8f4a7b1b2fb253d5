"""Toxic spans by a linear-chain conditional random field over words.

Labels belong to documents, so words are labelled from them: over all learnable texts Spark counts, for
every word and every word beginning and ending, in how many toxic and other texts it stands. Those that
stand out (``MIN_G2``, ``MIN_LIFT``, in ``MIN_SHARE`` of the toxic texts) and are mostly toxic
(``MIN_PRECISION``) mark the words of toxic texts as toxic.
The field's features are the log-odds of a word's own form, beginnings and endings, and of its neighbours'.
It is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); the table of forms that reaches the
driver and the tasks is bounded by ``MAX_FORMS``.

Forward-backward marginals give a document's score (the chance that any word is toxic and the expected
number of toxic words, set against the labels by a logistic curve) and the offending offsets.

A null or empty text has no words and gets the score of no evidence. Repeated rows are scored one by one.
Without labelled rows of both kinds every score is the smoothed share of label 1. Other columns pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .labelled import learnable, prior, sample

SAMPLE_ROWS = 1000
MAX_FORMS = 5000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
MIN_G2, MIN_LIFT, MIN_PRECISION = 25.0, 2.0, 0.8
MIN_TEXTS, MIN_SHARE = 3, 0.02
WORDS_AT_ONCE = 300_000
MAX_WORDS_KEPT = 400_000
WORD = re.compile(r"\w+")
NOT_WORD = r"[^\p{L}\p{N}_]+"
AFFIXES = (3, 4, 5)
KINDS = ["w", *[f"b{n}" for n in AFFIXES], *[f"e{n}" for n in AFFIXES]]
N_OWN = len(KINDS) + 2


def forms_of(word: str) -> list[str]:
    """The word's forms in the order of ``KINDS``: itself, its beginnings, its endings."""
    return [f"w{word}", *[f"b{n}{word[:n]}" for n in AFFIXES], *[f"e{n}{word[-n:]}" for n in AFFIXES]]


def form_table(docs: DataFrame, learn: DataFrame, n: int, ones: int) -> DataFrame:
    """``form``, ``n``, ``ones``: texts with it and toxic ones, the ``MAX_FORMS`` that stand out most.

    Copies of a text count once. Beginnings and endings add up the texts of their words.
    """
    labelled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(learn, "doc_id")
    one_each = labelled.withColumn("h", F.xxhash64("text")).select("doc_id", "h", "y")
    firsts = one_each.groupBy("h").agg(F.min(F.struct("doc_id", "y")).alias("f")).select("f.doc_id")
    texts = labelled.join(firsts, "doc_id", "left_semi")
    words = texts.select("y", F.explode(F.array_distinct(F.split(F.lower("text"), NOT_WORD))).alias("word")).where("word <> ''")
    every = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"))
    word = F.col("word")
    forms = F.array(
        F.concat(F.lit("w"), word),
        *[F.concat(F.lit(f"b{k}"), F.substring(word, 1, k)) for k in AFFIXES],
        *[F.concat(F.lit(f"e{k}"), F.substring(word, -k, k)) for k in AFFIXES],
    )
    by_form = every.select(F.explode(forms).alias("form"), "n", "ones").groupBy("form").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    rate = ones / n
    zero, rest = F.lit(0.0), F.col("n") - F.col("ones")
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (F.col("n") * share))).otherwise(zero)
    g2 = 2 * (part(F.col("ones"), rate) + part(rest, 1 - rate))
    standing_out = (F.col("ones") >= max(MIN_TEXTS, MIN_SHARE * ones)) & (F.col("ones") >= F.col("n") * (rate * MIN_LIFT)) & (F.col("g2") >= MIN_G2)
    return by_form.withColumn("g2", g2).where(standing_out).orderBy(F.desc("g2"), "form").limit(MAX_FORMS).select("form", "n", "ones")


@dataclass
class Words:
    """Number of each word's feature row; row 0 has no evidence. Emptied at a fixed size."""

    odds: dict[str, float]
    marking: frozenset[str]
    known: dict[str, int] = field(default_factory=dict)
    rows: list[tuple[float, ...]] = field(default_factory=lambda: [(0.0,) * N_OWN])

    def numbers(self, words: list[str]) -> np.ndarray:
        get, known = self.known.get, self.known
        found = list(map(get, words))
        if None in found:
            for word in words:
                if word not in known:
                    known[word] = self._number(word.lower())
            found = list(map(get, words))
        return np.array(found, np.int32)

    def _number(self, word: str) -> int:
        forms = forms_of(word)
        values = [self.odds.get(f, 0.0) for f in forms]
        if not any(values):
            return 0
        self.rows.append((*values, max(values), float(any(f in self.marking for f in forms))))
        return len(self.rows) - 1

    def trim(self) -> None:
        if len(self.known) > MAX_WORDS_KEPT:
            self.known.clear()
            del self.rows[1:]


@dataclass
class Model:
    odds: dict[str, float]
    marking: frozenset[str]
    weights: np.ndarray | None
    chain: crf.Chain | None
    curve: np.ndarray | None
    share: float

    def marginals(self, table: np.ndarray, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        own, before, after = (table @ self.weights[1 + i * N_OWN : 1 + (i + 1) * N_OWN] for i in range(3))
        odds = self.weights[0] + own[numbers]
        inside = ~first[1:]
        odds[1:] += before[numbers[:-1]] * inside
        odds[:-1] += after[numbers[1:]] * inside
        return crf.marginals(odds, first, self.chain)


def _curve_inputs(p: np.ndarray, begins: np.ndarray) -> np.ndarray:
    none = np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), begins)
    any_odds = np.log(np.maximum(-np.expm1(none), 1e-9)) - none
    return np.column_stack([np.clip(any_odds, -12, 12), np.log1p(np.add.reduceat(p, begins))])


def _features(table: np.ndarray, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, feature numbers and values: the constant, own features, those of the word before and after."""
    n = len(numbers)
    at, which, values = [np.arange(n)], [np.zeros(n, int)], [np.ones(n)]
    on = np.flatnonzero(numbers)
    for block, shift in enumerate((0, 1, -1)):
        to = on + shift
        ok = (to >= 0) & (to < n)
        if shift == 1:
            ok[ok] = ~first[to[ok]]
        if shift == -1:
            ok &= ~first[on]
        rows = table[numbers[on[ok]]]
        i, j = np.nonzero(rows)
        at.append(to[ok][i])
        which.append(1 + block * N_OWN + j)
        values.append(rows[i, j])
    return np.concatenate(at), np.concatenate(which), np.concatenate(values)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    learn = learnable(labels, "toxic", folds, held_out)
    n, ones = prior(learn)
    share = (ones + 1) / (n + 2)
    if not 0 < ones < n:
        return Model({}, frozenset(), None, None, None, share)
    forms = form_table(docs, learn, n, ones).collect()
    odds = {r["form"]: float(np.log((r["ones"] + 0.5) / (r["n"] - r["ones"] + 0.5)) - np.log(ones / (n - ones))) for r in forms}
    marking = frozenset(r["form"] for r in forms if r["ones"] >= MIN_PRECISION * r["n"])

    @F.arrow_udf("struct<n: int, at: binary, rows: binary>")
    def evidence(texts: pa.Array) -> pa.Array:
        words, out = Words(odds, marking), []
        for text in texts:
            numbers = words.numbers(WORD.findall(text.as_py() or ""))
            on = np.flatnonzero(numbers).astype("<i8")
            rows = np.array([words.rows[k] for k in numbers[on]], "<f4")
            out.append({"n": len(numbers), "at": on.tobytes(), "rows": rows.tobytes()})
        return pa.array(out, pa.struct([("n", pa.int32()), ("at", pa.binary()), ("rows", pa.binary())]))

    taken = sample(docs, learn, rows).select("y", evidence("text").alias("e")).collect()
    taken = [(r["y"], r["e"]) for r in taken if r["e"]["n"]]
    y = np.array([t[0] for t in taken])
    if len(set(y.tolist())) < 2:
        return Model({}, frozenset(), None, None, None, share)
    counts = np.array([e["n"] for _, e in taken])
    begins = np.cumsum(counts) - counts
    found = np.frombuffer(b"".join(e["rows"] for _, e in taken), "<f4").reshape(-1, N_OWN)
    table = np.concatenate((np.zeros((1, N_OWN)), found))
    numbers = np.zeros(counts.sum(), int)
    numbers[np.concatenate([b + np.frombuffer(e["at"], "<i8") for b, (_, e) in zip(begins, taken)])] = np.arange(1, len(table))
    first = np.zeros(len(numbers), bool)
    first[begins] = True
    labels_now = (np.repeat(y, counts) * (table[numbers, N_OWN - 1] > 0)).astype(int)
    weights, chain = crf.fit(*_features(table, numbers, first), 1 + 3 * N_OWN, labels_now, first, rounds=80)
    model = Model(odds, marking, weights, chain, None, share)
    p = model.marginals(table, numbers, first)
    model.curve = crf.fit_logistic(_curve_inputs(p, begins), y)
    return model


RESULT = "score double, n_spans long, spans string"


def with_toxicity(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a struct column ``name``: ``score``, ``n_spans`` and ``spans`` (start:end of toxic words, code points)."""

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        words = Words(model.odds, model.marking)
        scores, spans = np.full(len(texts), model.share), [""] * len(texts)
        no_evidence = crf.logistic(np.array([[-12.0, 0.0]]), model.curve)[0] if model.weights is not None else model.share

        def flush(rows: list[int], waiting: list[np.ndarray]) -> None:
            counts = np.array([len(w) for w in waiting])
            begins = np.cumsum(counts) - counts
            numbers = np.concatenate(waiting)
            first = np.zeros(len(numbers), bool)
            first[begins] = True
            p = model.marginals(np.array(words.rows), numbers, first)
            scores[rows] = crf.logistic(_curve_inputs(p, begins), model.curve)
            toxic = np.flatnonzero(p >= 0.5)
            for i in np.unique(np.searchsorted(begins, toxic, "right") - 1):
                marked = p[begins[i] : begins[i] + counts[i]] >= 0.5
                found = [m.span() for m, on in zip(WORD.finditer(texts[rows[i]].as_py()), marked) if on]
                spans[rows[i]] = ",".join(f"{a}:{b}" for a, b in found)

        rows, waiting, held = [], [], 0
        for row, text in enumerate(texts):
            numbers = words.numbers(WORD.findall(text.as_py() or "")) if model.weights is not None else ()
            if not len(numbers):
                scores[row] = no_evidence
                continue
            rows.append(row)
            waiting.append(numbers)
            held += len(numbers)
            if held >= WORDS_AT_ONCE:
                flush(rows, waiting)
                rows, waiting, held = [], [], 0
                words.trim()
        if waiting:
            flush(rows, waiting)
        n_spans = pa.array([s.count(":") for s in spans], pa.int64())
        return pa.StructArray.from_arrays([pa.array(scores), n_spans, pa.array(spans, pa.string())], ["score", "n_spans", "spans"])

    return docs.withColumn(name, judge(F.col("text").cast("string")))
