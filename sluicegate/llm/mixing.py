"""Sources mixed to target weights by Pfair scheduling.

Documents of a source are cut into blocks. Every slot of the mix takes one block; a source of weight w
releases its i-th block at slot floor((i-1)/w) and must have it placed by slot ceil(i/w). Earliest deadline
first among the released blocks meets all deadlines, so after any t slots a source has had w*t blocks, give
or take less than one.

Weights are whole shares of a period, so the schedule repeats: only one period is ever worked out, and a
block's slot follows from its number by a lookup and a multiplication. The slots of a source that has run out
stay empty, so the others go on in the same proportions, each within one block of its weight times the number of
slots passed, empty ones included. Nothing starts anew when a source runs out; with many sources that end together
a new start for each would hand the first slots of all of them to the source with the largest weight.

What reaches the driver is one row per source; the period is ``QUANTUM`` slots or ``SLOTS_EACH`` for each source. It
is broadcast up to ``BROADCAST_SLOTS`` and joined by source and place in the period beyond.

Blocks need the rank of a document within its source. Documents are range-partitioned by source and id and
written once; a rank is the row's place in its file plus the counts of earlier files, so a source with a
third of all rows is many tasks. No document is dropped or repeated.

A null source, or one without a weight, belongs to the rest, which has a weight of its own; ``every_source``
gives each source found a weight, so that only null and empty ones are left there. A period has ``QUANTUM`` slots
or ``SLOTS_EACH`` for each source, whichever is more; shares are rounded to whole slots. A source whose share is
below one slot gets one, at the cost of the others' shares, which shrink by at most one in ``SLOTS_EACH``. Null ids come
first; rows that repeat an id are ordered by the hash of their text. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kept import free_names, keep

BLOCK_ROWS = 16
QUANTUM = 1000
SLOTS_EACH = 100
BROADCAST_SLOTS = 1_000_000
REST = ""


def shares(weights: Mapping[str, float], rest: float, quantum: int = QUANTUM) -> dict[str, int]:
    """Whole shares of a period of ``quantum`` slots, by largest remainder; every positive weight has one at least."""
    given = {**weights, REST: rest}
    total = sum(given.values())
    if min(given.values()) < 0 or total <= 0:
        raise ValueError("weights must not be negative, and some must be positive")
    exact = {s: quantum * w / total for s, w in given.items() if w > 0}
    small = {s for s, x in exact.items() if x < 1}
    left, wanted = quantum - len(small), sum(x for s, x in exact.items() if s not in small)
    exact = {s: 1.0 if s in small else max(1.0, x * left / wanted) for s, x in exact.items()}
    # A share within rounding of a whole one is that one.
    whole = {s: int(x + 1e-9) for s, x in exact.items()}
    spare = quantum - sum(whole.values())
    for s in sorted(exact, key=lambda s: (whole[s] - exact[s], s))[: max(spare, 0)]:
        whole[s] += 1
    return whole


def every_source(docs: DataFrame, weights: Mapping[str, float], rest: float) -> tuple[dict[str, float], float]:
    """``weights`` with one for each other source of ``docs``, and what is left for null sources.

    ``rest`` is divided by the numbers of rows, so that the other sources go on until the last of their rows.
    """
    counted = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()
    others = {r["source"] or REST: 0 for r in counted if r["source"] not in weights}
    for r in counted:
        if r["source"] not in weights:
            others[r["source"] or REST] += r["n"]
    total = sum(others.values())
    if not total:
        return dict(weights), rest
    divided = {s: rest * n / total for s, n in others.items()}
    left = divided.pop(REST, 0.0)
    return {**weights, **divided}, left


def period(active: Mapping[str, int]) -> list[str]:
    """The source of each slot of one period: earliest deadline first among released blocks."""
    length = sum(active.values())
    done = dict.fromkeys(active, 0)
    waiting, released = [(0, s) for s in sorted(active)], []
    slots = []
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, s = heappop(waiting)
            # the deadline of block i + 1 is ceil((i + 1) * length / a)
            heappush(released, (-(-(done[s] + 1) * length // active[s]), s))
        _, first = heappop(released)
        done[first] += 1
        slots.append(first)
        if done[first] < active[first]:
            heappush(waiting, (done[first] * length // active[first], first))
    return slots


def _group(source: Column, weights: Mapping[str, float]) -> Column:
    return F.when(source.isin(list(weights)), source).otherwise(F.lit(REST)) if weights else F.lit(REST)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SLOTS else df


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float],
    rest: float,
    names: tuple[str, str, str] = ("block", "slot", "position"),
    block_rows: int = BLOCK_ROWS,
    quantum: int | None = None,
) -> DataFrame:
    """``docs`` with the block within its source, the slot of that block and the position of the row in the mix.

    A column of ``docs`` that has one of ``names`` keeps it; the new one gets underscores in front.

    Positions order the mix; a source's last block may hold fewer rows, and its remaining positions stay empty.
    """
    spark = docs.sparkSession
    names = free_names(docs, *names)
    quantum = quantum or max(QUANTUM, SLOTS_EACH * (len(weights) + 1))
    text = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    # The row travels as one column, so that no name of it meets those used here.
    ordered = (
        docs.select(F.struct(*docs.columns).alias("doc"), _group(F.col("source"), weights).alias("g"), text.alias("mark"))
        .repartitionByRange("g", "doc.doc_id", "mark")
        .sortWithinPartitions("g", "doc.doc_id", "mark")
    )
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = keep(ordered.select("doc", "g", F.spark_partition_id().alias("p"), row.alias("row")), "mix")
    counts = keep(staged.groupBy("g", "p").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")), "mix-counts")
    totals = {r["g"]: r["n"] for r in counts.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    shared = shares(weights, rest, quantum)
    missing = sorted(set(totals) - set(shared))
    if missing:
        raise ValueError(f"sources with rows need a positive weight: {missing}")
    offsets: dict[str, list[int]] = {}
    for slot, g in enumerate(period(shared)):
        offsets.setdefault(g, []).append(slot)
    # One row per file and source in it; one per slot of the period that a block can come to.
    earlier = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("g", "p", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    places = [(g, i, o) for g, n in totals.items() for i, o in enumerate(offsets[g][: -(-n // block_rows)])]
    place_table = spark.createDataFrame(places, "g string, i long, offset long")
    share_table = spark.createDataFrame([(g, len(offsets[g])) for g in totals], "g string, share long")
    ranked = staged.join(F.broadcast(shifts), ["g", "p"]).select("doc", "g", (F.col("row") + F.col("shift")).alias("rank"))
    shared_rows = ranked.withColumn("block", F.floor(F.col("rank") / block_rows)).join(_small(share_table, len(totals)), "g")
    slotted = (
        shared_rows.withColumn("i", F.col("block") % F.col("share"))
        .join(_small(place_table, len(places)), ["g", "i"])
        .withColumn("slot", F.floor(F.col("block") / F.col("share")) * sum(shared.values()) + F.col("offset"))
    )
    position = F.col("slot") * block_rows + F.col("rank") % block_rows
    made = zip((F.col("block"), F.col("slot"), position), names)
    return slotted.select("doc.*", *[c.alias(n) for c, n in made])


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float], rest: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` in the order of the mix: files in order, and rows in order within files."""
    names = free_names(docs, "block", "slot", "position")
    placed = mixed(docs, weights, rest, tuple(names), block_rows)
    return placed.repartitionByRange(names[2]).sortWithinPartitions(names[2]).select(*docs.columns)
