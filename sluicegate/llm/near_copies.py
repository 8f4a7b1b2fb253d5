"""Near copies by Jaccard similarity of word shingles: SimHash, then rare shingles for the rest, whole sets to verify.

The first candidates come from SimHash (``simhash.py``): fingerprints of five-word shingles, its index over positional
bytes, its count filter and its 3 bits. Those whose whole sets are similar make the first forest. A similarity of 0.8
reaches beyond 3 bits, so an index of rare shingles then finds every pair that the fingerprints leave out.

A text is the set of its shingles of ``SHINGLE`` words. All sets are ordered alike, rare shingles first. For a
similarity of ``MIN_NUM / MIN_DEN`` = 0.8 or more, the smaller of two sets shares one of its first ninth with the
first fifth of the larger, so only those are posted, and a pair meets under a shared one if sizes and places
still allow 0.8. No pair is missed. A passage that many texts share is common, so it stands late in their orders
and makes no candidates unless the rest of the texts is small, and then they are near copies. Candidates are verified
on their whole sets.

Which shingles are rare is read from a table of ``COUNTERS`` counters over all texts, summed over tasks and
broadcast as one byte a counter. Any table gives the same result, as all sets are ordered by the same one.

Texts with equal sets (by 128 bits) enter once. A group of near copies shares its rare shingles, so its pairs
are not all made: in ``LEADER_ROUNDS`` rounds every member of a list is compared with one member, and what is linked to
it needs no further comparison. Only members of a list that are then still in different components are compared
pair by pair, first by the parity of ``PARITY_BITS`` groups of their shingles: two sets differ in at least as many
shingles as groups whose parity differs, and similar ones in at most a ninth of both sizes. So what differs by more is no
pair at all, and none that is similar is lost (sets of several thousand shingles differ in half of all groups, which
excludes nothing). Components are the same as those of all pairs. Each round starts from the forest of the one before, and
tables that are no longer read are removed.

Texts and sets are long, so they are not shuffled whole: bitmaps of ids (``screen.py``) tell which rows a step needs, and
only repeated sets, sets of candidates and dropped documents pass a shuffle.

Nulls and texts without words have the empty set and are near copies of each other. A text of fewer words than
``SHINGLE`` is one shingle. Repeated rows are copies. Other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.control import remove
from . import simhash
from .components import components
from .kept import free_names, keep
from .screen import may_be_in, without

SHINGLE = 5
MIN_NUM, MIN_DEN = 4, 5
LEADER_ROUNDS = 3
SEED = 42
WORDS_AT_ONCE = 1 << 17
COUNTERS = 1 << 22
COUNTERS_A_CHUNK = 4096
ROWS_AT_ONCE = 1 << 16
SETS_AT_ONCE = 1 << 10
PARITY_BITS = 1024
PARITY = [f"parity{i}" for i in range(PARITY_BITS // 64)]
POSTED = "value long, rid long, size int, pos int"


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``text``."""
    import xxhash

    # On bytes, lower() and split() know ASCII only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    parts = []
    for i in range(0, len(words) - size + 1, WORDS_AT_ONCE):
        ends = len(words) - size + 1 - i
        shifted = (words[i + j : i + j + min(WORDS_AT_ONCE, ends)] for j in range(size))
        parts.append(np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*shifted))], np.uint64)))
    return np.unique(np.concatenate(parts))


def similar(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) * MIN_DEN < max(len(x), len(y)) * MIN_NUM:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared * MIN_DEN >= (len(x) + len(y) - shared) * MIN_NUM


def _signed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``: 128 bits for the shingle set."""

    @F.arrow_udf("binary")
    def sign(texts: pa.Array) -> pa.Array:
        import xxhash

        return pa.array([xxhash.xxh3_128_digest(shingle_set(t.as_py()).tobytes()) for t in texts], pa.binary())

    return docs.withColumn(name, sign(F.col("text").cast("string")))


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of ``PARITY_BITS`` groups of hashes whether it holds an odd number of ``hashes``, as 64-bit words."""
    odd = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _sets(texts: DataFrame) -> DataFrame:
    """``rid``, ``set`` and the words of its parity for each text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(i, SETS_AT_ONCE) for i in range(0, batch.num_rows, SETS_AT_ONCE)):
                found = [shingle_set(t.as_py()) for t in some.column("text")]
                words = np.array([parity(s) for s in found], np.int64).T
                columns = [some.column("rid"), pa.array([s.tobytes() for s in found], pa.binary()), *map(pa.array, words)]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "set", *PARITY])

    kinds = ", ".join(f"{p} long" for p in PARITY)
    return texts.select("rid", F.col("text").cast("string").alias("text")).mapInArrow(made, f"rid long, set binary, {kinds}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters = np.zeros(COUNTERS, np.uint32)
    for batch in batches:
        for text in batch.column("text"):
            # Two shingles of one text on one counter count once, which is as good an order.
            counters[shingle_set(text.as_py()) & np.uint64(COUNTERS - 1)] += 1
    for number, chunk in enumerate(counters.reshape(-1, COUNTERS_A_CHUNK)):
        if chunk.any():
            # In as few bytes a counter as the largest needs, which the length of the chunk tells.
            least = chunk.astype(np.min_scalar_type(chunk.max())).tobytes()
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int32()), "counters": pa.array([least], pa.binary())})


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of all tasks, sorted by number, to one byte a counter that rises with its logarithm."""
    number, total = None, None

    def levels() -> pa.RecordBatch:
        level = np.minimum(np.log2(total.astype(np.float64) + 1) * 6, 255).astype(np.uint8)
        return pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int32()), "levels": pa.array([level.tobytes()], pa.binary())})

    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counters")):
            counters = data.as_py()
            more = np.frombuffer(counters, f"u{len(counters) // COUNTERS_A_CHUNK}").astype(np.uint64)
            if chunk == number:
                total = total + more
                continue
            if number is not None:
                yield levels()
            number, total = chunk, more
    if number is not None:
        yield levels()


def rarity(texts: DataFrame) -> np.ndarray:
    """One byte for each of ``COUNTERS`` groups of shingles: how often they stand in all texts."""
    chunks = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "chunk int, counters binary")
    merged = chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed, "chunk int, levels binary")
    levels = np.zeros(COUNTERS, np.uint8)
    for row in merged.toLocalIterator():
        start = row["chunk"] * COUNTERS_A_CHUNK
        levels[start : start + COUNTERS_A_CHUNK] = np.frombuffer(row["levels"], np.uint8)
    return levels


def first_places(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The rarest fifth of a set, and one more: what a set of 0.8 similarity that is no larger must meet."""
    n = len(hashes)
    order = np.lexsort((hashes, levels[hashes & np.uint64(len(levels) - 1)]))
    return hashes[order[: n + (-MIN_NUM * n // MIN_DEN) + 1]] if n else hashes


def postings(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """``value, rid, size, pos`` for the first places of each text's set (``rid``, ``text``)."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("value", pa.int64()), ("rid", pa.int64()), ("size", pa.int32()), ("pos", pa.int32())])
        waiting, n_waiting = [], 0

        def out() -> pa.RecordBatch:
            values = np.concatenate([v for v, _, _ in waiting]).view(np.int64)
            lengths = [len(v) for v, _, _ in waiting]
            rids = np.repeat(np.array([r for _, r, _ in waiting], np.int64), lengths)
            sizes = np.repeat(np.array([n for _, _, n in waiting], np.int32), lengths)
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (values, rids, sizes, places)], schema=kind)

        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text")):
                hashes = shingle_set(text.as_py())
                if len(hashes):
                    waiting.append((first_places(hashes, shared.value), rid, len(hashes)))
                    n_waiting += len(waiting[-1][0])
                if n_waiting >= ROWS_AT_ONCE:
                    yield out()
                    waiting, n_waiting = [], 0
        if waiting:
            yield out()

    return texts.select("rid", F.col("text").cast("string").alias("text")).mapInArrow(post, POSTED)


# Whether two rows of a list may be 0.8 similar: by size, by places, and the smaller by its first ninth.
MEETS = """
    least(size, other_size) * 5 >= greatest(size, other_size) * 4
    AND least(size - pos, other_size - other_pos) >= (4 * (size + other_size) + 8) div 9
    AND CASE WHEN (size, rid) < (other_size, other) THEN pos <= size - (8 * size + 8) div 9
             ELSE other_pos <= other_size - (8 * other_size + 8) div 9 END"""

# Whether the parities of two sets leave 0.8 possible.
ALIKE = f"{' + '.join(f'bit_count({p} ^ other_{p})' for p in PARITY)} <= (size + other_size) div 9"


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar."""

    @F.arrow_udf("boolean")
    def verify(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([similar(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.bool_())

    left = sets.select(F.col("rid").alias("u"), F.col("set").alias("a"))
    right = sets.select(F.col("rid").alias("v"), F.col("set").alias("b"))
    return pairs.join(left, "u").join(right, "v").where(verify("a", "b")).select("u", "v")


def _forget(*tables: DataFrame | None) -> None:
    """Remove kept tables that nothing reads any more."""
    for table in tables:
        if table is not None:
            for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
                remove(table.sparkSession, folder)


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Candidates (u, v) of texts (``rid``, ``fp``): fingerprints linked by SimHash, and one link for each repeat of one."""
    firsts = keep(nodes.groupBy("fp").agg(F.min("rid").alias("first")), "prints")
    repeats = nodes.join(firsts, "fp").where("rid <> first").select(F.col("first").alias("u"), F.col("rid").alias("v"))
    near = simhash.links(firsts.select("fp")).withColumnsRenamed({"u": "fp", "v": "other_fp"})
    other = firsts.select(F.col("fp").alias("other_fp"), F.col("first").alias("other"))
    between = near.join(firsts, "fp").join(other, "other_fp").select(F.least("first", "other").alias("u"), F.greatest("first", "other").alias("v"))
    candidates = keep(repeats.unionByName(between), "candidates")
    _forget(firsts)
    return candidates


def roots(posted: DataFrame, staged: DataFrame, candidates: DataFrame) -> DataFrame:
    """``rid`` and ``root`` of the texts with a near copy.

    ``posted``: as of ``postings``. ``staged``: rid, text. ``candidates``: pairs (u, v) to try first, kept; removed here.
    """
    # Written, so that the join reads both sides from shuffles of its own and Spark can split a list.
    shared = keep(posted.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("value"), "shared")
    members = keep(posted.join(shared, "value"), "members")
    _forget(posted, shared)
    # Similar texts share a posted shingle, so candidates without a set here are not similar. A few sets more do no harm.
    ids = keep(members.select("rid").distinct(), "ids")
    sets = keep(_sets(staged.where(may_be_in(ids, "rid"))), "sets")
    _forget(ids)

    def grown(pairs: DataFrame, linked: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """The forest with the similar ones of ``pairs``, and ``members`` with its roots."""
        # Sets of other texts stay where they are.
        ids = pairs.select(F.col("u").alias("rid")).unionByName(pairs.select(F.col("v").alias("rid")))
        needed = keep(sets.select("rid", "set").where(may_be_in(ids, "rid")), "needed")
        links = keep(_verified(pairs, needed), "similar")
        # The forest so far stands for all links before.
        forest = links if linked is None else links.unionByName(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
        found = keep(components(forest), "roots")
        rooted = members.join(found, members["rid"] == found["node"], "left").select(*members.columns, F.coalesce("root", "rid").alias("root"))
        rooted = keep(rooted, "rooted")
        _forget(links, linked, needed)
        return found, rooted

    tried = candidates
    linked, rooted = grown(candidates, None)
    other = [F.col(c).alias(name) for c, name in (("rid", "other"), ("size", "other_size"), ("pos", "other_pos"), ("root", "other_root"))]
    for turn in range(LEADER_ROUNDS + 1):
        lead = F.min(F.struct(F.xxhash64("rid", F.lit(turn)).alias("h"), "rid", "size", "pos", "root")).alias("lead")
        mixed = rooted.groupBy("value").agg(lead, F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        mixed = keep(mixed.select("value", "lead.*").select("value", *other), "mixed")
        if mixed.isEmpty():
            _forget(mixed)
            break
        if turn < LEADER_ROUNDS:
            met = rooted.join(mixed, "value").where(f"root <> other_root AND {MEETS}")
        else:
            left = keep(rooted.join(mixed.select("value"), "value").join(sets.drop("set"), "rid"), "left")
            right = left.select("value", *other, *[F.col(p).alias(f"other_{p}") for p in PARITY])
            met = left.join(right, "value").where(f"root < other_root AND {MEETS} AND {ALIKE}")
        pairs = met.select(F.least("rid", "other").alias("u"), F.greatest("rid", "other").alias("v")).distinct()
        pairs = keep(pairs.join(tried, ["u", "v"], "left_anti"), "pairs")
        tried = tried.unionByName(pairs)
        before = rooted
        linked, rooted = grown(pairs, linked)
        _forget(mixed, before)
    result = keep(rooted.where("root <> rid").select("rid", "root").distinct(), "found")
    _forget(sets, members, tried, linked, rooted)
    return result


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of near copies: the one with the least ``doc_id``, of repeated rows any one.

    A component without any ``doc_id`` keeps one row too.
    """
    made, fp, rid = free_names(docs, "made", "fp", "rid")
    printed = simhash.with_fingerprint(_signed(docs, made), fp, SHINGLE)
    staged = keep(printed.withColumn(rid, F.monotonically_increasing_id()), "signed")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(rid).alias("rid"), F.col(fp).alias("fp")).alias("rank")
    thin = staged.select(F.col(made).alias("key"), rank)
    nodes = keep(thin.groupBy("key").agg(F.min("rank").alias("rank")).select("rank", "rank.rid", "rank.fp"), "nodes")
    texts = staged.select(F.col(rid).alias("rid"), "text")
    levels = rarity(texts)
    repeats = keep(texts.select("rid").join(nodes.select("rid"), "rid", "left_anti"), "repeats")
    posted = keep(postings(without(texts, repeats, "rid"), levels), "posted")
    _forget(repeats)
    found = roots(posted, texts, by_fingerprint(nodes))
    firsts = nodes.join(found, "rid", "left").groupBy(F.coalesce("root", "rid").alias("root")).agg(F.min("rank").alias("rank"))
    kept = keep(firsts.select(F.col("rank.rid").alias(rid)), "kept")
    gone = keep(staged.select(rid).join(kept, rid, "left_anti"), "gone")
    return without(staged, gone, rid).select(*docs.columns)
