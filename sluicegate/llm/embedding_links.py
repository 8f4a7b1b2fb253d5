"""Near copies of embeddings by counting collisions of one-dimensional projections.

Every vector is projected on many random lines. For a pair at the least cosine the distance on a line is
normal with a known spread, so a window of two spreads around the query holds the other vector with a known
chance, and the number of lines (of ``LINES``) on which a pair collides follows a binomial law: the count
that a pair must reach is the largest that keeps ``LINE_RECALL``. Pairs that reach it are verified by their
cosine in double precision.

A single window holds a third of all vectors, so counting over whole lines would touch all pairs. Counting
is therefore done inside cells of several views; a cell is an interval on each of a few other sorted lines.
The number of lines per cell grows with the logarithm of the table so that cells keep their size, and the
number of views follows from it for ``VIEW_RECALL`` at the least cosine; pairs that lie closer are found
with a higher chance. Cells larger than ``CELL_ROWS`` are compared block against block in separate tasks,
so no pair is given up and no group meets in one task. Nothing is emitted per pair: a task gives each
vector's number of new links (a pair counts in the first view whose cell it shares) and a spanning forest.

Vectors with equal components are one class with a count. Vectors that are null, of length zero, or hold
null or non-finite components link with nothing; so do vectors of different dimensions. Rows that repeat a
``vec_id`` keep a row each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .kept import keep

MIN_COSINE = 0.95
LINES = 8
LINE_RECALL = 0.99
VIEW_RECALL = 0.98
CELL_ROWS = 1024
CELL_WIDTH = 2.0
FAR_TOGETHER = 0.47
SEED = 11


def spread(min_cosine: float) -> float:
    """Distance of unit vectors at ``min_cosine``; their distance on a random line is normal with this deviation."""
    return math.sqrt(2 - 2 * min_cosine)


def least_count(lines: int = LINES, recall: float = LINE_RECALL) -> int:
    """Largest count that a pair at the least cosine reaches with chance ``recall``, with windows of two spreads."""
    inside, total, count = math.erf(math.sqrt(2)), 0.0, lines
    while count > 0:
        total += math.comb(lines, count) * inside**count * (1 - inside) ** (lines - count)
        if total >= recall:
            return count
        count -= 1
    return 0


def plan(n: int, min_cosine: float = MIN_COSINE, recall: float = VIEW_RECALL) -> tuple[int, int]:
    """Lines per cell and number of views for ``n`` vectors."""
    lines = max(1, round(math.log(max(1.0, 2 * n / CELL_ROWS)) / -math.log(FAR_TOGETHER)))
    together = 1 - spread(min_cosine) * math.sqrt(2 / math.pi) / CELL_WIDTH
    return lines, math.ceil(math.log(1 - recall) / math.log(1 - together**lines))


def _directions(dimension: int, lines: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, dimension, salt])
    return random.standard_normal((dimension, lines)), random.uniform(0, CELL_WIDTH, lines)


def _unit(rows: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cells(rows: list[bytes], kind: str, lines: int, views: int) -> np.ndarray:
    """A number per view for vectors of one dimension; vectors of one cell have the same."""
    x = _unit(rows, kind)
    out = np.empty((len(x), views), np.int64)
    for view in range(views):
        directions, offsets = _directions(x.shape[1], lines, view + 1)
        steps = np.floor((x @ directions + offsets) / CELL_WIDTH).astype(np.int64)
        code = np.full(len(x), x.shape[1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for column in steps.T:
            code = (code ^ column.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        out[:, view] = code.view(np.int64)
    return out


def _links(left: dict, right: dict | None, view: int, kind: str, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (in ``left`` then ``right``) that link and share no cell of an earlier view."""
    other = left if right is None else right
    x, y = _unit(left["vec"], kind), _unit(other["vec"], kind)
    directions, _ = _directions(x.shape[1], LINES, 0)
    p, q = (x @ directions).astype(np.float32), (y @ directions).astype(np.float32)
    window = np.float32(2 * spread(min_cosine))
    count = np.zeros((len(x), len(y)), np.int8)
    for line in range(LINES):
        count += np.abs(p[:, line, None] - q[None, :, line]) <= window
    passed = count >= least_count()
    if right is None:
        passed = np.triu(passed, 1)
    i, j = np.nonzero(passed)
    if len(i) > 8 * (len(x) + len(y)):
        ok = (x @ y.T)[i, j] >= min_cosine
    else:
        ok = np.einsum("ij,ij->i", x[i], y[j]) >= min_cosine
    i, j = i[ok], j[ok]
    if view and len(i):
        new = ~(left["codes"][i, :view] == other["codes"][j, :view]).any(1)
        i, j = i[new], j[new]
    return i, j + (0 if right is None else len(x))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place that each of ``n`` places reaches."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            return root


def _compared(views: int, kind: str, min_cosine: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {
                "key": np.column_stack([batch.column(c).to_numpy() for c in ("view", "bytes", "cell", "a", "b")]),
                "own": batch.column("own").to_numpy(),
                "cid": batch.column("cid").to_numpy(),
                "n": batch.column("n").to_numpy(),
                "vec": batch.column("vec").to_pylist(),
                "codes": np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<i8").reshape(-1, views),
            }
            if held is not None:
                now = {c: held[c] + now[c] if c == "vec" else np.concatenate((held[c], now[c])) for c in now}
            ends = np.flatnonzero((now["key"][1:] != now["key"][:-1]).any(1)) + 1
            last = int(ends[-1]) if len(ends) else 0
            yield from _each(now, [0, *ends.tolist()])
            held = {c: v[last:] for c, v in now.items()}
        if held is not None:
            yield from _each(held, [0, len(held["cid"])])

    def _each(rows: dict, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        ids, links, roots = [], [], []
        for start, stop in zip(bounds, bounds[1:]):
            if stop - start < 2:
                continue
            view, _, _, a, b = rows["key"][start].tolist()
            group = {c: v[start:stop] for c, v in rows.items()}
            right = None
            if a != b:
                side = np.argsort(group["own"] != a, kind="stable")
                n_left = int((group["own"] == a).sum())
                group = {c: [v[k] for k in side] if c == "vec" else v[side] for c, v in group.items()}
                right = {c: v[n_left:] for c, v in group.items()}
                if not 0 < n_left < len(side):
                    continue
            left = {c: v[: len(group["cid"]) - (len(right["cid"]) if right else 0)] for c, v in group.items()}
            i, j = _links(left, right, view, kind, min_cosine)
            if len(i):
                size = stop - start
                found = np.bincount(i, group["n"][j], size) + np.bincount(j, group["n"][i], size)
                root = _forest(size, i, j)
                on = np.flatnonzero(found)
                ids.append(group["cid"][on])
                links.append(found[on].astype(np.int64))
                roots.append(group["cid"][root[on]])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (ids, links, roots)], ["cid", "links", "root"])

    return compare


def _vectors(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` (vec_id, embedding) to ``vec_id`` and ``vec``, the bytes of a usable vector or null."""

    @F.arrow_udf("binary")
    def as_bytes(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors:
            x = v.values if v.is_valid else None
            if x is None or not len(x) or x.null_count:
                out.append(None)
                continue
            x = np.asarray(x).astype(kind)
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        return pa.array(out, pa.binary())

    return rows.select("vec_id", as_bytes("embedding").alias("vec"))


def linked(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    staged = keep(_vectors(vectors.select("vec_id", "embedding"), kind).withColumn("h", F.xxhash64("vec")), "vectors")
    by_class = staged.where(F.col("vec").isNotNull()).groupBy("h", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = keep(by_class.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    lines, views = plan(classes.count(), min_cosine)

    @F.arrow_udf("binary")
    def codes_of(vecs: pa.Array) -> pa.Array:
        rows = vecs.to_pylist()
        out = [b""] * len(rows)
        for size in {len(r) for r in rows}:
            at = [k for k, r in enumerate(rows) if len(r) == size]
            for k, code in zip(at, cells([rows[k] for k in at], kind, lines, views)):
                out[k] = code.tobytes()
        return pa.array(out, pa.binary())

    @F.arrow_udf("array<bigint>")
    def listed(codes: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(c.as_py(), "<i8").tolist() for c in codes], pa.list_(pa.int64()))

    coded = keep(classes.select("cid", "n", "vec", codes_of("vec").alias("codes")), "vector-cells")
    # Vectors of different dimensions never share a cell.
    width = F.length("vec").alias("bytes")
    placed = coded.select("cid", "n", "vec", "codes", width, F.posexplode(listed("codes")).alias("view", "cell"))
    thin = coded.select(width, F.posexplode(listed("codes")).alias("view", "cell"))
    sizes = thin.groupBy("view", "bytes", "cell").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / CELL_ROWS).cast("int")
    shared = sizes.where("size > 1").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    spread_out = (
        placed.join(shared, ["view", "bytes", "cell"])
        .withColumn("own", own)
        .withColumn("peer", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            *["view", "bytes", "cell", F.least("own", "peer").alias("a"), F.greatest("own", "peer").alias("b")],
            *["own", "cid", "n", "vec", "codes"],
        )
    )
    keys = ["view", "bytes", "cell", "a", "b"]
    grouped = spread_out.repartition(*keys).sortWithinPartitions(*keys)
    found = keep(grouped.mapInArrow(_compared(views, kind, min_cosine), "cid long, links long, root long"), "vector-links")
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    joined = classes.join(totals, "cid", "left").join(roots, classes["cid"] == roots["node"], "left")
    named = joined.select("h", "vec", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = named.join(least, "root").select("h", "vec", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id")
    rows = staged.join(per_class, ["h", "vec"], "left")
    component = F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    result = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
