"""Secrets: patterns, and sliding-window entropy over candidate strings (DataFrame expressions only).

Three base kinds are found by pattern. The method adds the kind ``entropy``: candidates are long runs of
key-like characters; a run belongs to the narrowest character class that holds all of it, and is a secret
when the Shannon entropy of some window reaches the class's threshold. The window slides by one character:
one count goes up, one goes down, and the running sum of ``c * log2 c`` changes by two table entries, so a
run costs a fixed amount per character whatever the window. An allow-list suppresses runs that look random
but are not secret (identifiers, digests of nothing, plain words).

One pass, no shuffle. Places come from the lengths of the pieces between matches; their running sums are
taken in two levels, so a text with very many matches stays cheap. Places are code points, end exclusive.

Nulls and empty texts have no spans. Repeated rows are scanned one by one. Columns beyond ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGNED = 6

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
WINDOW = 20
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[A-Za-z]+([_/+-]+[A-Za-z]+)*[_/+-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"EXAMPLE",
    r"^d41d8cd98f00b204e9800998ecf8427e$",
    r"^da39a3ee5e6b4b0d3255bfef95601890afd80709$",
    r"^e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855$",
)


@dataclass(frozen=True)
class CharClass:
    name: str
    pattern: str
    threshold: float


# From narrow to wide; a run is judged by the first that holds all its characters.
CLASSES = (
    CharClass("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 2.95),
    CharClass("upper", r"^[A-Z0-9]+$", 3.55),
    CharClass("lower", r"^[a-z0-9]+$", 3.55),
    CharClass("mixed", r"^[A-Za-z0-9+/_-]+$", 3.75),
)

BLOCK = 256


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: lambda bodies compute an outer expression at every step."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _block(i: Column) -> Column:
    return F.floor(i / BLOCK).cast("int")


def _starts(pieces: Column, matches: Column) -> Column:
    """Where each match begins, from the text between the matches."""
    n = F.size(matches)
    before = F.slice(F.concat(F.array(F.lit(0)), F.transform(matches, F.length)), 1, n)
    steps = F.zip_with(F.slice(F.transform(pieces, F.length), 1, n), before, lambda p, m: p + m)

    def block_sums(steps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), _block(F.size(steps) - 1)), lambda b: _total(F.slice(steps, b * BLOCK + 1, BLOCK)))

    def running(steps: Column, sums: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(steps) - 1),
            lambda i: _total(F.slice(sums, 1, _block(i))) + _total(F.slice(steps, _block(i) * BLOCK + 1, i % BLOCK + 1)),
        )

    return _bind(steps, lambda bound: _bind(block_sums(bound), lambda sums: running(bound, sums)))


SPANS = "array<struct<start:int,kind_no:int,kind:string,end:int>>"


def _spans(text: Column, pattern: str, kind_no: int, kind: str, matches: Column, keep: Column | None = None) -> Column:
    """Spans of ``matches`` (all matches of ``pattern``) that ``keep``, an array of flags, lets pass."""
    starts = _starts(F.split(text, pattern, -1), matches)
    placed = F.zip_with(
        matches,
        starts,
        lambda m, s: F.struct(
            s.alias("start"), F.lit(kind_no).alias("kind_no"), F.lit(kind).alias("kind"), (s + F.length(m)).alias("end")
        ),
    )
    if keep is not None:
        flagged = F.zip_with(placed, keep, lambda p, k: F.when(k, p))
        placed = F.filter(flagged, lambda p: p.isNotNull())
    return F.when(F.size(matches) > 0, placed.cast(SPANS)).otherwise(F.array().cast(SPANS))


def peak_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest entropy, in bits, of any window of ``run``; null when the run is shorter than a window.

    The counts of the window are the characters of a text, one per letter of the alphabet, so that a
    change of one count is one ``overlay``.
    """
    gain = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])

    def place(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(run, i, F.lit(1)))

    def count(counts: Column, at: Column) -> Column:
        return F.ascii(F.substring(counts, at, F.lit(1))) - 32

    def change(state: Column, at: Column, by: int) -> Column:
        def changed(known: Column) -> Column:
            counts, now, place_no = known.getField("counts"), known.getField("now"), known.getField("at")
            total = known.getField("total") + F.get(gain, now + by) - F.get(gain, now)
            return F.struct(
                F.overlay(counts, F.char(now + by + 32), place_no, F.lit(1)).alias("counts"), total.alias("total")
            )

        def counted(known: Column) -> Column:
            counts, place_no = known.getField("counts"), known.getField("at")
            return F.struct(
                counts.alias("counts"), known.getField("total").alias("total"), place_no.alias("at"), count(counts, place_no).alias("now")
            )

        known = F.struct(state.getField("counts").alias("counts"), state.getField("total").alias("total"), at.alias("at"))
        return _bind(known, lambda k: _bind(counted(k), changed))

    def step(state: Column, i: Column) -> Column:
        moved = _bind(
            change(state, place(i), 1),
            lambda entered: F.when(i > window, change(entered, place(i - window), -1)).otherwise(entered),
        )
        return _bind(
            moved,
            lambda m: F.struct(
                m.getField("counts").alias("counts"),
                m.getField("total").alias("total"),
                F.when(i >= window, F.least(state.getField("least"), m.getField("total")))
                .otherwise(state.getField("least"))
                .alias("least"),
            ),
        )

    first = F.struct(
        F.lit(" " * len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(float(window * window)).alias("least"),
    )
    least = F.aggregate(F.sequence(F.lit(1), F.length(run)), first, step, lambda s: s.getField("least"))
    return F.when(F.length(run) >= window, math.log2(window) - least / window)


def is_random(run: Column, classes: Sequence[CharClass], allowed: Sequence[str], window: int) -> Column:
    suppressed = F.lit(False)
    for pattern in allowed:
        suppressed = suppressed | run.rlike(pattern)
    threshold = F.when(run.rlike(classes[0].pattern), classes[0].threshold)
    for wider in classes[1:]:
        threshold = threshold.when(run.rlike(wider.pattern), wider.threshold)
    return F.when(suppressed, F.lit(False)).otherwise(
        F.coalesce(peak_entropy(run, window) >= threshold, F.lit(False))
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string"))
        ),
        ",",
    )


def scan(
    docs: DataFrame,
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, the base spans and all spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = [
        ("assign", ASSIGN),
        ("access", ACCESS),
        ("hex", HEX),
        ("entropy", CANDIDATE),
    ]
    matched = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{kind}") for kind, p in every]
    )
    assigned = F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= MIN_ASSIGNED)
    random = F.transform(F.col("m_entropy"), lambda run: is_random(run, classes, allowed, window))
    keep = {"assign": assigned, "entropy": random}
    placed = matched.select(
        "doc_id",
        *[
            _spans(F.col("text"), p, number, kind, F.col(f"m_{kind}"), keep.get(kind)).alias(f"s_{kind}")
            for number, (kind, p) in enumerate(every)
        ],
    )
    base = F.array_sort(F.concat("s_assign", "s_access", "s_hex"))
    joined = placed.select(
        "doc_id",
        *[F.size(f"s_{kind}").cast("long").alias(f"n_{kind}") for kind, _ in every],
        base.alias("base"),
        F.array_sort(F.concat("s_assign", "s_access", "s_hex", "s_entropy")).alias("found"),
    )
    return joined.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "n_entropy",
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        "found",
    )
