"""The prefix trie of conversations, with count-min screening so that only possibly shared prefixes are shuffled.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. A prefix is
known by 128 bits: the xor over its turns of two hashes of place and content. Xor is associative, so prefixes come
from a running aggregate whose partitions are blocks of ``BLOCK`` places of a conversation; a conversation with a
third of all turns is many partitions.

**Screening.** Each task counts its prefixes in a count-min sketch of saturating counters. Of the merged sketch
only one bit a counter is kept, "two or more", at most ``SKETCH_ROWS * MAX_WIDTH / 8`` bytes, which is broadcast. A
prefix with a counter below two in any row has one member. All that a trie holds of such a node follows from the
member's own row, which emits it in place. Prefixes that the sketch cannot clear are grouped exactly, so the
sketch changes what is shuffled and never the result.

**Grouping.** Counts, leaves and saved tokens of a shared node are sums over its members, with partial sums in
every task: each leaf and each node is counted by one member, its smallest, and reaches the node's ancestors by a
running sum along that member's path. Joins with grouped nodes read both sides from shuffles, so Spark splits
a node with many members. The members that end in a node are hashed as one text; sorted runs of ids are joined to
parts first, and one task streams the parts of a node.

Rows without ``conv_id`` belong to no conversation. Turns are ordered by ``turn`` (nulls first), then role, then
text; null role and text are empty; repeated rows are turns of their own. An empty table gives no nodes, not even
a root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import lookup
from .kept import keep

BLOCK = 1024
SKETCH_ROWS = 4
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 24
COUNTERS_A_CHUNK = 4096
IDS_A_PART = 4096
FAMILY = 5
MAX_BORROWED = 8
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ("p1", "p2")
PARENT = ("q1", "q2")


def running(rows: DataFrame, key: str, block: Column, order: Column, **totals: tuple[str, str]) -> DataFrame:
    """``rows`` with aggregates over each row and the rows of its ``key`` before it, in ``order``.

    ``totals`` gives for each new column an aggregate function and the column it takes. ``block`` rises with
    ``order`` and cuts a key into groups that are worked on apart; blocks are then summed up. ``rows`` is read twice.
    """
    cut = rows.withColumn("_block", block)
    inside = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    aggregate = {"sum": F.sum, "xor": F.bit_xor}
    join = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    local = cut.withColumns({name: aggregate[how](column).over(inside) for name, (how, column) in totals.items()})
    whole = cut.groupBy(key, "_block").agg(*[aggregate[how](column).alias(name) for name, (how, column) in totals.items()])
    earlier = whole.select(
        F.struct(key, "_block").alias("_place"), *[aggregate[how](name).over(before).alias(f"_{name}") for name, (how, _) in totals.items()]
    )
    # Only conversations of more than one block have earlier blocks.
    earlier = keep(earlier.where(F.col(f"_{next(iter(totals))}").isNotNull()), "blocks")
    found = lookup(local.withColumn("_place", F.struct(key, "_block")), earlier, "_place", order)
    added = {name: join[how](F.col(name), F.coalesce(f"_{name}", F.lit(0))) for name, (how, _) in totals.items()}
    return found.withColumns(added).drop("_block", "_place", *[f"_{name}" for name in totals])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, place ``i`` from 1, two numbers ``a``, ``b`` of 60 bits for role and text, and ``bytes`` of the text."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one"),
    )
    first = F.lit(-(2**63))
    order = F.struct(F.coalesce(F.col("turn").cast("long"), first), F.col("turn").isNotNull(), "role", "text")
    ranked = running(turns, "conv_id", F.coalesce(F.floor(F.col("turn").cast("long") / BLOCK), first), order, i=("sum", "one"))
    digest = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    number = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    return keep(ranked.select("conv_id", "i", number(1).alias("a"), number(16).alias("b"), F.octet_length("text").cast("long").alias("bytes")), "turns")


def as_they_are(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns and lengths of the conversations for ``nodes``."""
    turns = ordered_turns(conversations)
    convs = keep(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")), "convs")
    return keep(turns.withColumnRenamed("i", "d").join(convs, "conv_id"), "paths"), convs


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns taken from the first of its family of ``FAMILY`` ids.

    With h the crc32 of the decimal id modulo 9, the first h turns come from that conversation (all if it has fewer,
    none if there is none) and its own turns after its first h follow.
    """
    turns = ordered_turns(conversations)
    own = keep(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "own")
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    h = (F.crc32(F.col("conv_id").cast("string")) % (MAX_BORROWED + 1)).alias("h")
    heads = own.select(F.col("conv_id").alias("head"), F.col("n").alias("n_head"))
    joined = own.select("conv_id", "n", h, head.alias("head")).join(heads, "head", "left")
    borrowed = F.least("h", F.coalesce("n_head", F.lit(0)))
    convs = joined.select("conv_id", "h", borrowed.alias("borrowed"), (borrowed + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = keep(convs, "convs")
    kept = ("conv_id", "d", "length", "a", "b", "bytes")
    later = turns.join(convs, "conv_id").where("i > h").withColumn("d", F.col("i") - F.col("h") + F.col("borrowed")).select(*kept)
    guests = F.transform(F.sequence(F.lit(0), F.lit(FAMILY - 1)), lambda k: F.col("conv_id") + k)
    lent = turns.where((F.col("i") <= MAX_BORROWED) & (F.pmod("conv_id", F.lit(FAMILY)) == 0))
    lent = lent.withColumn("conv_id", F.explode(guests)).join(convs, "conv_id").where("i <= h").withColumn("d", F.col("i")).select(*kept)
    return keep(later.unionByName(lent), "paths"), convs


def _slots(p1: np.ndarray, p2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The counter of each prefix in each row of the sketch."""
    for k in range(SKETCH_ROWS):
        mixed = (p1 + np.uint64(k) * (p2 | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        yield (mixed >> np.uint64(32)) & np.uint64(width - 1)


def _unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64, copy=False).view(np.uint64)


def _counted(width: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            for row, slots in zip(counters, _slots(_unsigned(batch.column("p1")), _unsigned(batch.column("p2")), width)):
                found, times = np.unique(slots, return_counts=True)
                row[found] = np.minimum(row[found] + np.minimum(times, 2), 2)
        for number, chunk in enumerate(counters.reshape(-1, COUNTERS_A_CHUNK)):
            if chunk.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int32()), "counters": pa.array([chunk.tobytes()], pa.binary())})

    return count


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of all tasks, sorted by number, to one bit a counter: two or more."""
    number, counters = None, None

    def bits() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int32()), "bits": pa.array([np.packbits(counters >= 2).tobytes()], pa.binary())})

    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counters")):
            more = np.frombuffer(data.as_py(), np.uint8)
            if chunk == number:
                counters = np.minimum(counters + more, 2)
                continue
            if number is not None:
                yield bits()
            number, counters = chunk, more
    if number is not None:
        yield bits()


def screened(paths: DataFrame, *wanted: tuple[str, tuple[str, str]]) -> DataFrame:
    """``paths`` with a flag for each ``(name, columns)``: true where the sketch proves one member of that prefix."""
    spark = paths.sparkSession
    width = min(MAX_WIDTH, max(MIN_WIDTH, 1 << (2 * paths.count()).bit_length()))
    chunks = paths.select(*NODE).mapInArrow(_counted(width), "chunk int, counters binary")
    merged = chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merged, "chunk int, bits binary")
    bits = np.zeros(SKETCH_ROWS * width // 8, np.uint8)
    for row in merged.toLocalIterator():
        start = row["chunk"] * COUNTERS_A_CHUNK // 8
        bits[start : start + COUNTERS_A_CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def one_member(p1: pa.Array, p2: pa.Array) -> pa.Array:
        several = shared.value.reshape(SKETCH_ROWS, -1)
        proved = np.zeros(len(p1), bool)
        for row, slots in zip(several, _slots(_unsigned(p1), _unsigned(p2), width)):
            slots = slots.astype(np.int64)
            proved |= (row[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 0
        return pa.array(proved)

    return paths.withColumns({name: one_member(*columns) for name, columns in wanted})


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows to texts of at most ``IDS_A_PART`` ids."""
    node, ids = None, []

    def part() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "p1": pa.array([node[0]], pa.int64()),
                "p2": pa.array([node[1]], pa.int64()),
                "first": pa.array([ids[0]], pa.int64()),
                "part": pa.array([",".join(map(str, ids))], pa.string()),
            }
        )

    for batch in batches:
        for p1, p2, conv_id in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if (p1, p2) != node or len(ids) == IDS_A_PART:
                if ids:
                    yield part()
                node, ids = (p1, p2), []
            ids.append(conv_id)
    if ids:
        yield part()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, part) rows to one hash a node, of all its parts joined by commas."""
    node, running_hash = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"p1": pa.array([node[0]], pa.int64()), "p2": pa.array([node[1]], pa.int64()), "ends": pa.array([running_hash.hexdigest()], pa.string())}
        )

    for batch in batches:
        for p1, p2, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "part"))):
            if (p1, p2) == node:
                running_hash.update(b",")
            else:
                if node is not None:
                    yield row()
                node, running_hash = (p1, p2), hashlib.sha256()
            running_hash.update(text.encode())
    if node is not None:
        yield row()


def ends_hashes(members: DataFrame) -> DataFrame:
    """``p1, p2, ends``: the hash of the sorted ids in ``members`` (p1, p2, conv_id)."""
    kept = keep(members, "ends")
    ranged = kept.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = ranged.mapInArrow(_parts, "p1 long, p2 long, first long, part string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hashed, "p1 long, p2 long, ends string")


def nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, d, length, a, b, bytes) and all ``convs`` (conv_id, length): one row per node.

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Both tables are read several times and are to be stored.
    """
    marked = turns.select("conv_id", "d", "length", "bytes", F.xxhash64("d", "a", "b").alias("x1"), F.xxhash64("b", "a", "d", F.lit(1)).alias("x2"))
    marked = keep(marked, "marked")
    paths = running(marked, "conv_id", F.floor((F.col("d") - 1) / BLOCK), F.col("d"), p1=("xor", "x1"), p2=("xor", "x2"))
    paths = keep(paths.select("conv_id", "d", "length", "bytes", *NODE, *[F.col(p).bitwiseXOR(x).alias(q) for p, x, q in zip(NODE, (F.col("x1"), F.col("x2")), PARENT)]), "prefixes")
    flagged = keep(screened(paths, ("alone", NODE), ("after_alone", PARENT)), "screened")
    flagged = flagged.withColumn("after_alone", F.col("after_alone") & (F.col("d") > 1))
    shared, tails = flagged.where("NOT alone"), flagged.where("alone")
    under_shared = ~F.col("after_alone") & (F.col("d") > 1)
    heads = tails.where(under_shared)
    here, is_end = lambda cs: [F.col(c).alias(p) for p, c in zip(NODE, cs)], F.col("d") == F.col("length")

    grouped = shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("least"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_end).alias("n_ends"),
        F.max("bytes").alias("size"),
        F.max("d").alias("depth"),
        *[F.max(c).alias(c) for c in (*PARENT, "after_alone")],
    )
    # Written, so that the joins read both sides from shuffles of their own and Spark can split a node.
    grouped = keep(grouped, "nodes")
    known = grouped.select(*NODE, "least", "n", "n_ends", "size")
    rows = shared.select("conv_id", "d", "length", *NODE, F.lit(False).alias("is_head"))
    rows = rows.unionByName(heads.select("conv_id", "d", "length", *here(PARENT), F.lit(True).alias("is_head")))
    met = keep(rows.join(known, list(NODE)), "met")

    on_shared, owns = met.where("NOT is_head"), F.col("least") == F.col("conv_id")
    counted = on_shared.select(
        "conv_id",
        "d",
        *NODE,
        F.when(owns, (F.col("n") - 1) * F.col("size")).otherwise(0).alias("saving"),
        (owns & is_end & (F.col("n_ends") == F.col("n"))).cast("long").alias("leaf"),
    )
    nowhere = [F.lit(None).cast("long").alias(c) for c in NODE]
    lone_ends = tails.where(is_end & (F.col("d") > 1)).select("conv_id", "d", *nowhere, F.lit(0).cast("long").alias("saving"), F.lit(1).cast("long").alias("leaf"))
    counted = keep(counted.unionByName(lone_ends), "counted")
    below = running(counted, "conv_id", -F.floor(F.col("d") / BLOCK), -F.col("d"), n_leaves=("sum", "leaf"), saved=("sum", "saving"))

    root = [F.lit(0).cast("long").alias(c) for c in NODE]
    n_root_leaves = F.when(F.col("n_ends") == F.col("n"), 1).otherwise(0)
    ends = on_shared.where(is_end)
    several = ends.where("n_ends > 1").select(*NODE, "conv_id").unionByName(convs.where("length = 0").select(*root, "conv_id"))
    hashed = ends_hashes(several)
    one = F.lit(1).cast("long")
    facts = [
        below.where(F.col("p1").isNotNull()).select(*NODE, "n_leaves", "saved"),
        grouped.where(under_child := ~F.col("after_alone") & (F.col("depth") > 1)).select(*here(PARENT), one.alias("n_children")),
        heads.select(*here(PARENT), one.alias("n_children")),
        grouped.select(
            *root,
            n_root_leaves.cast("long").alias("n_leaves"),
            ((F.col("n") - 1) * F.col("size")).alias("saved"),
            (F.col("depth") == 1).cast("long").alias("n_children"),
        ),
        tails.where(is_end).select(*root, one.alias("n_leaves")),
        tails.where("d = 1").select(*root, one.alias("n_children")),
        ends.where("n_ends = 1").select(*NODE, F.sha2(F.col("conv_id").cast("string"), 256).alias("ends")),
        hashed,
        grouped.select(*NODE, F.col("least").alias("conv_id"), "depth", "n", *PARENT, "after_alone"),
        convs.agg(F.min("conv_id").alias("conv_id"), F.count(one).alias("n")).where("n > 0").select(*root, "conv_id", "n", F.lit(0).cast("long").alias("depth")),
    ]
    union = facts[0]
    for more in facts[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    whole = union.groupBy(*NODE).agg(
        *[total(c) for c in ("n_leaves", "saved", "n_children")], *[F.max(c).alias(c) for c in ("ends", "conv_id", "depth", "n", *PARENT, "after_alone")]
    )
    whole = keep(whole.where("n IS NOT NULL"), "whole")
    first = convs.agg(F.min("conv_id")).first()[0]
    top = F.lit(first).cast("long")

    of_parent = whole.where("depth > 0").select(*here(NODE), F.col("conv_id").alias("above"))
    under = whole.where(under_child).drop(*NODE).select("*", *here(PARENT)).join(of_parent, list(NODE))
    others = whole.where(~F.coalesce(under_child, F.lit(False)))
    above = F.when(F.col("depth") == 1, top).when(F.col("depth") > 1, F.col("conv_id"))
    columns = ("conv_id", "depth", "above", "n", "n_children", "n_leaves", "saved", "ends")
    parts = under.select(*columns).unionByName(others.withColumn("above", above).select(*columns))
    lone = lambda rows, above: rows.select(
        "conv_id",
        F.col("d").alias("depth"),
        above.alias("above"),
        one.alias("n"),
        (~is_end).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved"),
        F.when(is_end, F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends"),
    )
    parts = parts.unionByName(lone(tails.where(~under_shared), F.when(F.col("d") == 1, top).otherwise(F.col("conv_id"))))
    parts = parts.unionByName(lone(met.where("is_head"), F.col("least")))
    return parts.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.greatest("n_leaves", one).alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
