"""Document quality by a linear-chain conditional random field over lines.

Each line has features of its own form (length, word repetition, letters, digits, marks) and those of its
neighbours; the field labels it good (1) or bad (0). Documents carry the labels, so lines of labelled-bad
documents start as bad and are relabelled by the field in a few rounds, with at least one staying bad.
The length-weighted mean of the forward-backward marginals, set against the labels by a logistic curve,
is the document's score.

The field is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); scoring reads whole texts of
all rows. Only the features of the sample reach the driver.

A null or empty text is one empty line and gets the score such a line has. Repeated rows are scored one by
one. Without labelled rows of both kinds every score is the smoothed share of label 1. Other columns pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .labelled import learnable, prior, sample

SAMPLE_ROWS = 4000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
RELABELS = 2
LINES_AT_ONCE = 200_000

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
DIGITS = b"0123456789"
BLANK = b" \t\r\x0b\x0c"
COMMON_MARKS = b".,;:'\"()-?!"
MARK_RUN = re.compile(r"[^\w\s]{2,}")
N_OWN = 24
N_ALL = 3 * N_OWN + 3


def line_features(line: str, seen: set[str]) -> tuple[float, ...]:
    data, words = line.encode("utf-8", "surrogatepass"), line.split()
    size, n = max(1, len(data)), max(1, len(words))
    upper = len(data) - len(data.translate(None, UPPER))
    lower = len(data) - len(data.translate(None, LOWER))
    digits = len(data) - len(data.translate(None, DIGITS))
    blank = len(data) - len(data.translate(None, BLANK))
    marks = len(data) - len(data.translate(None, COMMON_MARKS))
    ascii_rest = len(data.decode("latin-1").encode("ascii", "ignore")) - upper - lower - digits - blank - marks
    distinct = len(set(words)) / n
    repeated = sum(map(eq, words, words[1:])) / n
    letters = max(1, upper + lower)
    runs = len(MARK_RUN.findall(line)) / n
    again = line in seen
    seen.add(line)
    capitals, symbols, punctuation, numbers = upper / letters, ascii_rest / size, marks / size, digits / size
    return (
        np.log1p(len(data)) / 5,
        np.log1p(len(words)) / 4,
        len(data) / n / 10,
        distinct,
        repeated,
        capitals,
        symbols,
        punctuation,
        numbers,
        blank / size,
        runs,
        float(again),
        float(not words),
        float(len(words) < 4),
        float(line[:1].isupper()),
        float(line.rstrip()[-1:] in ".!?"),
        float(distinct < 0.5),
        float(distinct < 0.8),
        float(repeated > 0.2),
        float(capitals > 0.5),
        float(symbols > 0.02),
        float(symbols > 0.1),
        float(punctuation > 0.1),
        float(runs > 0.1),
    )


def text_features(text: str | None) -> np.ndarray:
    """One row per line: own features, then the line's weight (its length)."""
    seen: set[str] = set()
    lines = (text or "").split("\n")
    return np.array([(*line_features(line, seen), len(line) + 1.0) for line in lines], np.float32)


def _with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    last = np.append(first[1:], True)
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    return np.column_stack([np.ones(len(own)), own, before, after, first, last])


@dataclass
class Model:
    weights: np.ndarray | None
    chain: crf.Chain | None
    curve: np.ndarray | None
    share: float

    def line_marginals(self, own: np.ndarray, first: np.ndarray) -> np.ndarray:
        return crf.marginals(_with_neighbours(own, first) @ self.weights, first, self.chain)

    def scores(self, p: np.ndarray, weight: np.ndarray, begins: np.ndarray) -> np.ndarray:
        mean = np.add.reduceat(p * weight, begins) / np.add.reduceat(weight, begins)
        return crf.logistic(_curve_inputs(mean), self.curve)


def _curve_inputs(mean: np.ndarray) -> np.ndarray:
    return np.column_stack([mean, np.log((mean + 1e-3) / (1 - mean + 1e-3))])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    learn = learnable(labels, "quality", folds, held_out)
    n, ones = prior(learn)
    share = (ones + 1) / (n + 2)

    @F.arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(t.as_py()).tobytes() for t in texts], pa.binary())

    taken = sample(docs, learn, rows).select("y", features("text").alias("lines")).collect()
    if len({r["y"] for r in taken}) < 2:
        return Model(None, None, None, share)
    per_doc = [np.frombuffer(r["lines"], np.float32).reshape(-1, N_OWN + 1) for r in taken]
    y = np.array([r["y"] for r in taken])
    counts = np.array([len(d) for d in per_doc])
    begins = np.cumsum(counts) - counts
    table = np.concatenate(per_doc).astype(float)
    own, weight = table[:, :N_OWN], table[:, N_OWN]
    first = np.zeros(len(own), bool)
    first[begins] = True
    x = _with_neighbours(own, first)
    at, which = np.nonzero(x)
    line_y = np.repeat(y, counts)
    labels_now = line_y.copy()
    for turn in range(RELABELS + 1):
        weights, chain = crf.fit(at, which, x[at, which], x.shape[1], labels_now, first)
        p = crf.marginals(x @ weights, first, chain)
        if turn < RELABELS:
            labels_now = np.where(line_y == 1, 1, (p > 0.5).astype(int))
            worst = np.minimum.reduceat(p, begins)
            labels_now[(line_y == 0) & (p <= np.repeat(worst, counts))] = 0
    mean = np.add.reduceat(p * weight, begins) / np.add.reduceat(weight, begins)
    return Model(weights, chain, crf.fit_logistic(_curve_inputs(mean), y), share)


RESULT = "score double, n_lines long, n_bad_lines long"


def with_quality(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a struct column ``name``: ``score``, ``n_lines``, ``n_bad_lines``."""

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        scores, lines, bad = [], [], []

        def flush(waiting: list[np.ndarray]) -> None:
            table = np.concatenate(waiting).astype(float)
            counts = np.array([len(d) for d in waiting])
            begins = np.cumsum(counts) - counts
            first = np.zeros(len(table), bool)
            first[begins] = True
            p = model.line_marginals(table[:, :N_OWN], first)
            scores.append(model.scores(p, table[:, N_OWN], begins))
            lines.append(counts)
            bad.append(np.add.reduceat((p < 0.5).astype(np.int64), begins))

        waiting, held = [], 0
        for text in texts:
            if model.weights is None:
                scores.append([model.share])
                lines.append([(text.as_py() or "").count("\n") + 1])
                bad.append([0])
                continue
            waiting.append(text_features(text.as_py()))
            held += len(waiting[-1])
            if held >= LINES_AT_ONCE:
                flush(waiting)
                waiting, held = [], 0
        if waiting:
            flush(waiting)
        join = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind))
        return pa.StructArray.from_arrays(
            [join(scores, np.float64), join(lines, np.int64), join(bad, np.int64)], ["score", "n_lines", "n_bad_lines"]
        )

    return docs.withColumn(name, judge(F.col("text").cast("string")))
