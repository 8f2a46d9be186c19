"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of few dimensions. Vectors with cosine ``c`` or more
are at most ``2 - 2c`` apart in squared distance, so in at least one block they are no further apart
than that block's proportional share. Each block is range-joined on its leading coordinate under
its own budget; what comes close in a block is verified exactly on the whole vectors. A pair counts
in the first block that brings it together, and tasks send link counts and spanning forests, never
the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import components, shuffle_width
from panelcast.session import written

#: Vectors in one slab of a range join; a task compares two slabs, 32 MB of vectors in double precision.
SLAB = 16384
FOUND = "node long, links long, a long, b long"


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, not zero, no null or non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int, seed: int = 11) -> np.ndarray:
    """A fixed random rotation, so that no block holds more of the vectors than another by its position."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def units(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Blocks:
    """How rotated vectors of a length are cut, and how far apart linked ones may be in each block."""

    def __init__(self, size: int, threshold: float, count: int):
        self.parts = [p for p in np.array_split(np.arange(size), count) if len(p)]
        limit = (2 - 2 * threshold) * (1 + 1e-6) + 1e-9  # room for rounding; the cosine decides
        self.budgets = [limit * len(p) / size for p in self.parts]
        self.radii = [budget**0.5 for budget in self.budgets]


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links ``a[i], b[i]`` those that connect what all of them connect."""
    parent: dict[int, int] = {}
    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = x, y
        while (up := parent.setdefault(p, p)) != p:
            parent[p] = p = parent[up]
        while (up := parent.setdefault(q, q)) != q:
            parent[q] = q = parent[up]
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return kept


def compare(block: int, same: bool, left: tuple, right: tuple, blocks: Blocks, turn: np.ndarray, threshold: float) -> pa.Table:
    """Links between two slabs whose first close block is ``block``: counts by vector, and a forest.

    ``left`` and ``right`` are ids, multiplicities and unit vectors; ``same`` if they are one slab.
    """
    (ids, weight, x), (other, other_weight, y) = left, right
    rx, ry = x @ turn, y @ turn
    part, budget = blocks.parts[block], blocks.budgets[block]
    fx, fy = rx[:, part], ry[:, part]
    # one product gives squared distances: (-2x, |x|^2, 1) times (y, 1, |y|^2)
    fx = np.column_stack([-2 * fx, (fx * fx).sum(1), np.ones(len(fx))]).astype(np.float32)
    fy = np.column_stack([fy, np.ones(len(fy)), (fy * fy).sum(1)]).astype(np.float32).T
    links, other_links = np.zeros(len(ids), np.int64), np.zeros(len(other), np.int64)
    edges: list[tuple[int, int]] = []
    for start in range(0, len(ids), 256):
        rows = slice(start, start + 256)
        at = np.flatnonzero(fx[rows] @ fy <= np.float32(budget + 1e-4))
        i, j = at // max(1, len(other)), at % max(1, len(other))
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 100_000):
            p, q = i[k : k + 100_000], j[k : k + 100_000]
            linked = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
            p, q = p[linked], q[linked]
            first = np.full(len(p), -1)
            for c in range(block, -1, -1):
                d = rx[np.ix_(p, blocks.parts[c])] - ry[np.ix_(q, blocks.parts[c])]
                first[(d * d).sum(1) <= blocks.budgets[c]] = c
            p, q = p[first == block], q[first == block]
            np.add.at(links, p, other_weight[q])
            np.add.at(other_links, q, weight[p])
            edges += forest(ids[p], other[q])
    a, b = (np.array(side, np.int64) for side in zip(*edges, strict=True)) if edges else (np.empty(0, np.int64),) * 2
    if len(a):
        a, b = (np.array(side, np.int64) for side in zip(*forest(a, b), strict=True))
    nodes, counts = np.r_[ids[links > 0], other[other_links > 0]], np.r_[links[links > 0], other_links[other_links > 0]]
    n, m = len(nodes), len(a)
    return pa.table({
        "node": pa.array([*nodes.tolist(), *[None] * m], pa.int64()), "links": pa.array([*counts.tolist(), *[None] * m], pa.int64()),
        "a": pa.array([*[None] * n, *a.tolist()], pa.int64()), "b": pa.array([*[None] * n, *b.tolist()], pa.int64()),
    })


def linked(nodes: DataFrame, size: int, threshold: float = 0.9, block_count: int = 4, slab: int = SLAB) -> DataFrame:
    """Link counts ``node, links`` and connecting links ``a, b`` among ``node, weight, vector``.

    All vectors have ``size`` components. Every block is cut into slabs of about ``slab`` vectors
    along its leading coordinate, and each slab meets those that begin within the block's radius.
    """
    turn, blocks = rotation(size), Blocks(size, threshold, block_count)
    leads = [int(p[0]) for p in blocks.parts]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = units(batch.column("vector"), size) @ turn[:, leads]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(at), pa.list_(pa.float64()))], names=["node", "weight", "vector", "lead"]
                )

    kind = dict(nodes.dtypes)["vector"]
    placed = written(nodes.select("node", "weight", "vector").mapInArrow(lead, f"node long, weight long, vector {kind}, lead array<double>"), "vectors")
    count = placed.count()
    slabs = max(1, -(-count // slab))
    cuts: list[np.ndarray] = []
    if slabs > 1:
        shares = [i / slabs for i in range(1, slabs)]
        row = placed.agg(*(F.percentile_approx(F.col("lead")[k], shares, 100 * slabs) for k in range(len(leads)))).first()
        cuts = [np.unique(np.array(c)) for c in row]
    else:
        cuts = [np.empty(0)] * len(leads)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("lead").flatten().to_numpy().reshape(-1, len(leads))
            for k, (cut, radius) in enumerate(zip(cuts, blocks.radii, strict=True)):
                x = at[:, k]
                own = np.searchsorted(cut, x, "right")
                last = np.searchsorted(cut, x + radius, "right")  # slabs that begin within reach
                first = np.searchsorted(cut, x - radius, "right")  # slabs that end within reach
                ahead, behind = last - own + 1, own - first
                row = np.r_[np.repeat(np.arange(len(x)), ahead), np.repeat(np.arange(len(x)), behind)].astype(np.int64)
                step = np.r_[np.arange(ahead.sum()) - np.repeat(np.cumsum(ahead) - ahead, ahead),
                             np.arange(behind.sum()) - np.repeat(np.cumsum(behind) - behind, behind)]
                side = np.r_[np.zeros(ahead.sum(), np.int32), np.ones(behind.sum(), np.int32)]
                low = np.where(side == 0, own[row], first[row] + step)
                high = np.where(side == 0, own[row] + step, own[row])
                for begin in range(0, len(row), 20_000):
                    part = slice(begin, begin + 20_000)
                    took = pa.array(row[part])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(took), k, np.int32)), pa.array(low[part].astype(np.int32)), pa.array(high[part].astype(np.int32)),
                        pa.array(side[part]), *(batch.column(c).take(took) for c in ("node", "weight", "vector")),
                    ], names=["block", "low", "high", "side", "node", "weight", "vector"])

    def meet(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side = group.column("side").to_numpy()
        block, low, high = (group.column(c)[0].as_py() for c in ("block", "low", "high"))

        def part(mask: np.ndarray) -> tuple:
            rows = group.filter(pa.array(mask)).combine_chunks()
            vectors = rows.column("vector")
            vectors = vectors.chunk(0) if vectors.num_chunks else pa.array([], vectors.type)
            return rows.column("node").to_numpy(), rows.column("weight").to_numpy(), units(vectors, size) if len(rows) else np.empty((0, size))

        left = part(side == 0)
        return compare(block, low == high, left, left if low == high else part(side == 1), blocks, turn, threshold)

    dealt = placed.mapInArrow(deal, f"block int, low int, high int, side int, node long, weight long, vector {kind}")
    tiles = dealt.repartition(4 * shuffle_width(nodes.sparkSession), "block", "low", "high")
    return tiles.groupBy("block", "low", "high").applyInArrow(meet, FOUND)


def near_duplicates(rows: DataFrame, threshold: float = 0.9, block_count: int = 4, slab: int = SLAB) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``.

    Equal vectors are one node with a multiplicity, so a group of copies costs one vector. Rows
    whose vector is null, empty, zero or has null or non-finite components link with nothing, and
    vectors of different lengths do not link. Rows that share a ``vec_id`` are vectors of their own.
    Other columns are not read; no rows give no rows.
    """
    spark = rows.sparkSession
    keyed = rows.select("vec_id", "embedding", usable(F.col("embedding")).alias("good")).withColumn(
        "node", F.when(F.col("good"), F.xxhash64("embedding"))
    )
    nodes = written(
        keyed.filter("good").groupBy("node", F.col("embedding").alias("vector"))
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")), "vector-nodes"
    )
    sizes = [r.n for r in nodes.select(F.size("vector").alias("n")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        part = linked(nodes.filter(F.size("vector") == size), size, threshold, block_count, slab)
        found = part if found is None else found.union(part)
    found = written(found if found is not None else spark.createDataFrame([], FOUND), "vector-links")
    roots = components(found.filter("a IS NOT NULL").select("a", "b"))
    counts = found.filter("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.select("node", "weight", "least").join(
        roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left"
    ).select("node", "weight", "least", F.coalesce("root", "node").alias("root"))
    names = classes.groupBy("root").agg(F.min("least").alias("name"))
    known = classes.join(names, "root").join(counts, "node", "left").select(
        F.col("node").alias("_node"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("name")
    )
    out = keyed.select("vec_id", "node").join(known, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
