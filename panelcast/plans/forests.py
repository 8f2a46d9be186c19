"""A forest of deep trees, grown where its rows lie. The rows to score go down the trees while they grow.

Trees of free depth have about as many nodes as rows, so neither the driver nor a worker holds a
forest. Nodes with many rows are split from histograms that all tasks add up, for all trees at a
time. A node with at most ``rows_in_task`` rows goes to one task with its rows, which grows what is
below it level by level and gives the forecasts of the rows to score that end there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A task grows a node of this many different rows in some 200 MB.
ROWS_IN_TASK = 200_000
# Rows of this number are drawn for all trees at a time; blocks of fewer only add to their cost.
ROWS_IN_DRAW = 10_000
# Levels of a tree in a task whose nodes have this many rows or more on average add up all bins.
ROWS_IN_DENSE = 32
# Histograms of this many nodes are counted at a time, at most; each has features x bins x 2 numbers.
NODES_AT_A_TIME = 1000
# A row is drawn as often as a Poisson variable with mean 1.
DRAWN = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 18)]))


def thresholds(rows: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper ends of at most ``bins`` bins a feature: all its values if they are few, else quantiles."""
    parts = [i / bins for i in range(1, bins)]
    facts = rows.agg(*(F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(features)),
                     *(F.percentile_approx(c, parts, 10_000).alias(f"q{i}") for i, c in enumerate(features))).first()
    some = [i for i in range(len(features)) if facts[f"n{i}"] <= 2 * bins]  # one job for all of them; so few values that a row holds them
    sets = rows.agg(*(F.collect_set(features[i]).alias(f"s{i}") for i in some)).first() if some else {}
    found = []
    for i in range(len(features)):
        values = facts[f"q{i}"] or []
        if i in some:
            few = np.unique(np.array(sets[f"s{i}"], np.float64))
            values = few if len(few) <= bins else values
        found.append(np.unique(np.array(values, np.float64))[: bins - 1])
    return found


def binned(batch: pa.RecordBatch, limits: Sequence[np.ndarray], names: Sequence[str]) -> np.ndarray:
    """features x rows: how many limits lie below each value."""
    return np.stack([np.searchsorted(t, batch.column(c).to_numpy(zero_copy_only=False)) for t, c in zip(limits, names, strict=True)]).astype(np.uint8)


def drawn(key: np.ndarray, copies: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the bootstrap of a tree holds each row; fixed by the row, its copies, the tree and the seed."""
    at = np.repeat(np.arange(len(key)), copies)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
    with np.errstate(over="ignore"):
        h = key.astype(np.uint64)[at] + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + copy.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    times = np.searchsorted(DRAWN, (h >> np.uint64(11)) * 2.0**-53, "right")
    return np.bincount(at, times, len(key))


@dataclass
class Top:
    """The upper nodes of a tree. ``feature`` is -1 where it is not split; ``value`` is set where it ends."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    value: list[float | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, cut: int) -> list[int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for _ in range(2):
            self.feature.append(-1), self.cut.append(0), self.left.append(0)
            self.depth.append(self.depth[node] + 1), self.value.append(None)
        return [self.left[node], self.left[node] + 1]

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        at, column = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        if len(self.feature) == 1:
            return at
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        while (inner := feature[at] >= 0).any():
            at = np.where(inner, left[at] + (bins[feature[at], column] > cut[at]), at)
        return at


def grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, least: int, asked: np.ndarray, grid: float = 2.0**24,
          dense: int = ROWS_IN_DENSE) -> np.ndarray:
    """Forecasts of the ``asked`` bins by one tree on all rows (features x rows), all nodes of a level at a time.

    The split of a node leaves the least squared error, the first feature and bin in a tie; nodes end where no
    split lessens it, or ``depth`` is reached. Levels whose nodes have ``dense`` rows or more on average add up
    every bin of every node; below, every feature keeps the rows in order of node and bin. A node that no asked
    row comes to has no forecast to give and is not split. Errors are judged on targets in steps of
    1 / ``grid``, whose sums are exact in any order.
    """
    out, at = np.zeros(asked.shape[1]), np.zeros(asked.shape[1], np.int64)
    waiting = np.arange(asked.shape[1])
    wy, exact, left_of = w * (np.rint(y * grid) / grid), w * y, np.zeros(len(y), bool)
    wide, search = int(bins.max(initial=0)) + 1, dense_splits
    order, starts = np.argsort(bins[:1], axis=1, kind="stable").astype(np.int32), np.zeros(1, np.int64)
    for level in range(depth + 1):
        rows = order[0]
        size = np.diff(np.append(starts, len(rows)))
        total, weight = np.add.reduceat(wy[rows], starts), np.add.reduceat(w[rows], starts)
        split = (np.maximum.reduceat(y[rows], starts) > np.minimum.reduceat(y[rows], starts)) & (level < depth)
        split &= np.bincount(at, minlength=len(size)) > 0
        for measured in (False, True):
            if measured and split.any():
                if search is dense_splits and len(order[0]) < dense * len(size):
                    search, order = sorted_splits, in_order(bins, order[0], size)
                most, feature, cut = search(bins, order, starts, size, w, wy, weight, total, least, wide)
                split = most > total**2 / weight
            if split.all():
                continue
            ends = ~split[at]  # rows to score whose node is not split get its mean
            out[waiting[ends]] = (np.add.reduceat(exact[order[0]], starts) / weight)[at[ends]]
            waiting, at = waiting[~ends], (np.cumsum(split) - 1)[at[~ends]]
            order = np.compress(np.repeat(split, size), order, axis=1)
            total, weight, size = total[split], weight[split], size[split]
            starts = np.cumsum(size) - size
            if measured and split.any():
                feature, cut = feature[split], cut[split]
            if not len(size) or not len(waiting):
                return out
            split = np.ones(len(size), bool)
        seg, rows = np.repeat(np.arange(len(size)), size), order[0]
        left_of[rows] = bins[feature[seg], rows] <= cut[seg]
        lefts = np.add.reduceat(left_of[rows].astype(np.int64), starts)
        left_from, right_from = np.cumsum(lefts) - lefts, np.cumsum(size - lefts) - (size - lefts)
        place = np.empty(len(rows), np.int64)  # where the n-th row that goes left, or right, comes to lie
        n = lefts.sum()
        place[:n] = np.arange(n) + np.repeat(starts - left_from, lefts)
        place[n:] = np.arange(len(rows) - n) + np.repeat(starts + lefts - right_from, size - lefts)
        moved = np.empty_like(order)
        for o, m in zip(order, moved, strict=True):
            goes = left_of[o]
            m[place] = np.concatenate([o[goes], o[~goes]])
        at = 2 * at + (asked[feature[at], waiting] > cut[at])
        order, starts = moved, np.stack([starts, starts + lefts], 1).ravel()
    return out


def in_order(bins: np.ndarray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of every feature the rows by node and bin, from the rows by node."""
    kind = np.uint16 if len(size) <= 1 << 16 else np.int64
    node, here = np.repeat(np.arange(len(size)), size).astype(kind), bins[:, rows]
    order = np.empty(here.shape, np.int32)
    for f, b in enumerate(here):
        by_bin = np.argsort(b, kind="stable")
        order[f] = rows[by_bin[np.argsort(node[by_bin], kind="stable")]]
    return order


def dense_splits(bins, order, starts, size, w, wy, weight, total, least, wide):
    """Gain, feature and bin of the best split of every node, from the sums of all bins of all nodes."""
    rows, k = order[0], len(size)
    base, here = np.repeat(np.arange(k) * wide, size), bins[:, order[0]]
    wr, wyr, each = w[rows], wy[rows], np.arange(k)
    most, feature, cut = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, bins.dtype)
    for f in range(len(bins)):
        cell = base + here[f]
        lower = np.cumsum(np.bincount(cell, wr, k * wide).reshape(k, wide), axis=1)
        below = np.cumsum(np.bincount(cell, wyr, k * wide).reshape(k, wide), axis=1)
        gain = gains(lower, below, weight[:, None], total[:, None], max(least, 0.5))
        best = gain.argmax(axis=1)
        better = gain[each, best] > most
        most[better], feature[better], cut[better] = gain[each, best][better], f, best[better]
    return most, feature, cut


def sorted_splits(bins, order, starts, size, w, wy, weight, total, least, wide):
    """The same from the rows in order of node and bin, where most bins of a node are empty."""
    k, last = len(size), starts + size - 1
    seg, before = np.repeat(np.arange(k), size), np.cumsum(weight) - weight
    summed = np.cumsum(total) - total  # exact, as all sums of the targets in steps
    most, feature, cut = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, bins.dtype)
    for f, o in enumerate(order):
        here = bins[f][o]
        differs = here[:-1] != here[1:]
        differs[last[:-1]] = False
        edge = np.flatnonzero(differs)  # a split is only judged where the bin changes inside a node
        if not len(edge):
            continue
        node = seg[edge]
        lower, below = np.cumsum(w[o])[edge] - before[node], np.cumsum(wy[o])[edge] - summed[node]
        gain = gains(lower, below, weight[node], total[node], least)
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        mine = node[first]
        best = np.maximum.reduceat(gain, first)
        better = best > most[mine]
        hits = np.flatnonzero(gain == np.repeat(best, np.diff(np.append(first, len(gain)))))
        at = hits[np.searchsorted(hits, first)][better]
        most[mine[better]], feature[mine[better]], cut[mine[better]] = best[better], f, here[edge[at]]
    return most, feature, cut


def gains(lower: np.ndarray, below: np.ndarray, weight: np.ndarray, total: np.ndarray, least: float) -> np.ndarray:
    """What a split with weight ``lower`` and sum ``below`` on its left side takes off the squared error, plus a constant."""
    upper = weight - lower
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = below**2 / lower + (total - below) ** 2 / upper
    gain[(lower < least) | (upper < least)] = -np.inf
    return gain


def best_split(histogram: np.ndarray, least: int) -> tuple[int, int] | None:
    """Feature and bin of the best split from (features x bins x weight and sum), None if none is better."""
    lower, below = np.cumsum(histogram, axis=1).transpose(2, 0, 1)
    weight, total = lower[:, -1:], below[:, -1:]
    upper, fits = weight - lower, (lower >= max(least, 0.5)) & (weight - lower >= max(least, 0.5))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, below**2 / lower + (total - below) ** 2 / upper, -np.inf)
    feature, cut = np.unravel_index(gain.argmax(), gain.shape)
    return (int(feature), int(cut)) if gain[feature, cut] > (total**2 / weight)[0, 0] * (1 + 1e-12) else None


@dataclass(frozen=True)
class DeepForest:
    """``trees`` trees on the ``different`` rows of ``kept``: the features as ``x0..``, ``y``, ``key`` and ``copies``."""

    kept: DataFrame
    different: int
    features: tuple[str, ...]
    limits: list[np.ndarray]
    mean: float
    trees: int
    depth: int
    least: int
    seed: int
    rows_in_task: int
    grid: float

    @property
    def names(self) -> list[str]:
        return [f"x{i}" for i in range(len(self.features))]

    @property
    def dealt(self) -> DataFrame:
        """``kept`` in tasks of many rows, whatever number of partitions it has."""
        return self.kept.coalesce(max(1, -(-self.different // ROWS_IN_DRAW)))

    def tops(self) -> list[Top]:
        """The nodes with more rows than a task takes, split from histograms over all rows."""
        limits, names, trees, seed, mean, least, grid = self.limits, self.names, self.trees, self.seed, self.mean, self.least, self.grid
        tops = [Top() for _ in range(trees)]
        if self.different <= self.rows_in_task:
            return tops
        wide, shape = max(len(t) for t in limits) + 1, (len(names), max(len(t) for t in limits) + 1, 2)
        waiting = [(t, 0) for t in range(trees)]
        while waiting:
            now, waiting = waiting[:NODES_AT_A_TIME], waiting[NODES_AT_A_TIME:]
            asked: dict[int, list[int]] = {}
            for t, node in now:
                asked.setdefault(t, []).append(node)

            def histograms(batches: Iterator[pa.RecordBatch], asked=asked, tops=tops) -> Iterator[pa.RecordBatch]:
                sums = {t: np.zeros((len(nodes), *shape)) for t, nodes in asked.items()}
                counts = {t: np.zeros(len(nodes), np.int64) for t, nodes in asked.items()}
                for batch in batches:
                    bins = binned(batch, limits, names)
                    key, copies = batch.column("key").to_numpy(), batch.column("copies").to_numpy()
                    y = batch.column("y").to_numpy() - mean
                    for t, nodes in asked.items():
                        slot = np.full(len(tops[t].feature), -1)
                        slot[nodes] = np.arange(len(nodes))
                        w, slot = drawn(key, copies, t, seed), slot[tops[t].walk(bins)]
                        mine = np.flatnonzero((w > 0) & (slot >= 0))
                        cell = ((slot[mine] * len(names) + np.arange(len(names))[:, None]) * wide + bins[:, mine]).ravel()
                        for k, values in enumerate((w[mine], (w * (np.rint(y * grid) / grid))[mine])):
                            found = np.bincount(cell, np.tile(values, len(names)), len(nodes) * len(names) * wide)
                            sums[t][..., k] += found.reshape(len(nodes), *shape[:2])
                        counts[t] += np.bincount(slot[mine], minlength=len(nodes))
                for t, nodes in asked.items():
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()),
                        "n": pa.array(counts[t]), "sums": pa.array([s.tobytes() for s in sums[t]], pa.binary())})

            def judged(group: pa.Table) -> pa.Table:
                total = np.sum([np.frombuffer(s.as_py()).reshape(shape) for s in group["sums"]], axis=0)
                weight, value = total[0].sum(axis=0)
                feature, cut = best_split(total, least) or (-1, 0)
                return pa.table({"tree": group["tree"][:1], "node": group["node"][:1], "n": [sum(group["n"].to_pylist())],
                                 "feature": pa.array([feature], pa.int32()), "cut": pa.array([cut], pa.int32()),
                                 "value": [float(value / weight) if weight else 0.0]})

            counted = self.dealt.mapInArrow(histograms, "tree int, node int, n long, sums binary").groupBy("tree", "node")
            found = counted.applyInArrow(judged, "tree int, node int, n long, feature int, cut int, value double").collect()
            for r in sorted(found, key=lambda r: (r.tree, r.node)):
                top = tops[r.tree]
                if r.n <= self.rows_in_task:
                    continue
                if r.feature >= 0 and top.depth[r.node] < self.depth:
                    waiting += [(r.tree, child) for child in top.split(r.node, r.feature, r.cut)]
                else:
                    top.value[r.node] = r.value
        return tops

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` with the mean of the trees as ``predicted_points``; equal features are scored once."""
        limits, names, trees, seed, mean = self.limits, self.names, self.trees, self.seed, self.mean
        least, depth, grid = self.least, self.depth, self.grid
        tops = self.tops()
        wanted = [F.col(c).cast("double").alias(n) for c, n in zip(self.features, names, strict=True)]
        asked = df.select(*wanted).distinct()
        marks = [F.xxhash64(F.lit(i), *(F.col(c).cast("double") + 0.0 for c in self.features)).alias(f"_mark{i}") for i in range(2)]
        asked = asked.select("*", *(F.xxhash64(F.lit(i), *(F.col(n) + 0.0 for n in names)).alias(f"_mark{i}") for i in range(2)))
        schema = "tree int, node int, bins binary, y binary, w binary, marks binary"

        def blocks(bins: np.ndarray, tree: int, marks: np.ndarray | None, y=None, w=None) -> pa.RecordBatch:
            """The rows of one tree, packed by node; ends of the top carry their value as a row."""
            top, at = tops[tree], tops[tree].walk(bins)
            rows = []
            for node in np.unique(at):
                mine, value = np.flatnonzero(at == node), top.value[node]
                if marks is not None:
                    known = (bytes(len(names)), np.array([value]).tobytes(), np.ones(1).tobytes()) if value is not None else (b"", b"", b"")
                    rows.append((tree, node, *known, np.ascontiguousarray(bins[:, mine].T).tobytes() + marks[mine].tobytes()))
                elif value is None:
                    rows.append((tree, node, np.ascontiguousarray(bins[:, mine].T).tobytes(), y[mine].tobytes(), w[mine].tobytes(), None))
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
            columns = list(zip(*rows, strict=True)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "node", "bins", "y", "w", "marks"])

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, y = binned(batch, limits, names), batch.column("y").to_numpy() - mean
                key, copies = batch.column("key").to_numpy(), batch.column("copies").to_numpy()
                for t in range(trees):
                    w = drawn(key, copies, t, seed)
                    used = np.flatnonzero(w)
                    yield blocks(bins[:, used], t, None, y[used], w[used])

        def to_score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = binned(batch, limits, names)
                marks = np.stack([batch.column(f"_mark{i}").to_numpy() for i in range(2)], 1)
                for t in range(trees):
                    yield blocks(bins, t, marks)

        def scored(group: pa.Table) -> pa.Table:
            f, rows = len(names), group.to_pylist()
            bins = np.frombuffer(b"".join(r["bins"] for r in rows), np.uint8).reshape(-1, f).T
            y, w = (np.frombuffer(b"".join(r[c] for r in rows)) for c in "yw")
            asked, marks = [], []
            for r in rows:
                if r["marks"]:
                    n = len(r["marks"]) // (f + 16)
                    asked.append(np.frombuffer(r["marks"], np.uint8, n * f).reshape(n, f))
                    marks.append(np.frombuffer(r["marks"], np.int64, 2 * n, n * f).reshape(n, 2))
            if not asked:
                return pa.table({"_mark0": pa.array([], pa.int64()), "_mark1": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
            asked, marks = np.concatenate(asked).T, np.concatenate(marks)
            order = np.lexsort((w, y, *bins))  # sums do not depend on the order in which blocks come
            left = depth - tops[rows[0]["tree"]].depth[rows[0]["node"]]
            value = grown(np.ascontiguousarray(bins[:, order]), y[order], w[order], left, least, asked, grid) if len(y) else np.zeros(len(marks))
            return pa.table({"_mark0": marks[:, 0], "_mark1": marks[:, 1], "value": value + mean})

        groups = sum(f < 0 for top in tops for f in top.feature)
        packed = self.dealt.mapInArrow(learned, schema).unionByName(asked.mapInArrow(to_score, schema))
        dealt = packed.repartition(groups, "tree", "node").groupBy("tree", "node")
        values = dealt.applyInArrow(scored, "_mark0 long, _mark1 long, value double").groupBy("_mark0", "_mark1").agg(
            F.array_sort(F.collect_list("value")).alias("_values"))
        total = F.aggregate("_values", F.lit(0.0), lambda a, b: a + b)
        means = values.select("_mark0", "_mark1", (total / trees).alias("predicted_points"))
        return df.withColumns({f"_mark{i}": m for i, m in enumerate(marks)}).join(means, ["_mark0", "_mark1"], "left").drop("_mark0", "_mark1")


def deep_forest(rows: DataFrame, features: Sequence[str], target: str, trees: int, depth: int, bins: int, least: int, seed: int,
                rows_in_task: int = ROWS_IN_TASK) -> DeepForest:
    """A forest on rows without missing values. Equal rows are kept once with their number, each copy drawn on its own."""
    names = [f"x{i}" for i in range(len(features))]
    plain = rows.select(*(F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)), F.col(target).cast("double").alias("y"))
    limits = thresholds(plain, names, bins)
    kept = plain.groupBy(*names, "y").agg(F.count(F.lit(1)).alias("copies")).withColumn("key", F.xxhash64(*names, "y")).persist()
    facts = kept.agg(F.count(F.lit(1)).alias("different"), F.sum("copies").alias("n"), (F.sum(F.col("y") * F.col("copies")) / F.sum("copies")).alias("mean"),
                     (F.max("y") - F.min("y")).alias("width")).first()
    # the middle is rounded, since the sum of doubles behind it depends on their order
    grid = 2.0 ** min(30, np.floor(np.log2(2.0**50 / (facts["n"] * max(facts["width"], 1e-9)))))  # no sum of a tree reaches 2**53 steps
    return DeepForest(kept, facts["different"], tuple(features), limits, round(facts["mean"], 3), trees, depth, least, seed, rows_in_task, float(grid))
