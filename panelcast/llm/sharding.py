"""Shards of near equal bytes by a histogram sort.

Rows are ordered by a key: a hash of the text, then a hash of the id, so equal texts are
neighbours. In each round all partitions count the exact bytes between candidate boundaries, and
the interval around every splitter shrinks to the cell its target falls into, until the bytes below
a boundary meet the tolerance or no row is left to move. The rows are exchanged once, at the end.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import numbered
from panelcast.session import written

LEAST, MOST = -(2**63), 2**63 - 1
Key = tuple[int, int]
CELL = "cell int, bytes long, rows long, h0 long, h1 long, t0 long, t1 long"


def with_keys(docs: DataFrame) -> DataFrame:
    """``_doc``, the whole row, its key ``_h, _t`` and ``_size``: UTF-8 bytes of the text (null: none) plus 1."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), F.xxhash64(text).alias("_h"),
        F.xxhash64("doc_id").alias("_t"), (F.octet_length(text) + 1).cast("long").alias("_size"),
    )


def spaced(low: Key, high: Key, count: int) -> list[Key]:
    """Up to ``count`` keys between ``low`` and ``high``, evenly spaced in the part where they differ."""
    at = 0 if low[0] != high[0] else 1
    first, last = low[at], high[at]
    values = sorted({first + (last - first) * i // (count + 1) for i in range(1, count + 2)} - {first})
    return [(v, LEAST) if at == 0 else (low[0], v) for v in values]


def counted(keys: DataFrame, probes: list[Key]) -> dict[int, tuple]:
    """Bytes, rows and the least and largest key parts of the rows between neighbouring probes.

    Cell ``i`` holds the rows with exactly ``i`` probes at or below their key. Tasks send one row
    a cell, so what arrives is bounded by the number of probes.
    """
    first = np.array([p[0] for p in probes], np.int64)
    second = np.array([p[1] for p in probes], np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, t, size = (batch.column(c).to_numpy() for c in ("_h", "_t", "_size"))
            cell = np.searchsorted(first, h, "right")
            for value in np.unique(first[second != LEAST]):  # probes inside one text's rows
                rows = np.flatnonzero(h == value)
                lower = np.searchsorted(first, value, "left")
                upper = np.searchsorted(first, value, "right")
                cell[rows] = lower + np.searchsorted(second[lower:upper], t[rows], "right")
            order = np.argsort(cell, kind="stable")
            cells, starts = np.unique(cell[order], return_index=True)
            if len(cells):
                h, t, size = h[order], t[order], size[order]
                columns = [cells.astype(np.int32), np.add.reduceat(size, starts), np.diff([*starts, len(order)]),
                           np.minimum.reduceat(h, starts), np.maximum.reduceat(h, starts),
                           np.minimum.reduceat(t, starts), np.maximum.reduceat(t, starts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int32 if i == 0 else np.int64)) for i, c in enumerate(columns)],
                    names=["cell", "bytes", "rows", "h0", "h1", "t0", "t1"],
                )

    found = keys.select("_h", "_t", "_size").mapInArrow(count, CELL).groupBy("cell").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("h0").alias("h0"), F.max("h1").alias("h1"),
        F.min("t0").alias("t0"), F.max("t1").alias("t1"),
    )
    return {r.cell: tuple(r)[1:] for r in found.collect()}


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.002, probes: int = 48) -> list[Key]:
    """The ``shards - 1`` boundaries; a shard's bytes start at its boundary.

    A boundary counts as met when the bytes below it miss their target by at most ``tolerance`` of
    a shard. Boundaries lie between texts; only where the rows of one text are too many bytes for
    that do they lie between ids of the same text. Rows with the same text and id stay together.
    """
    whole = counted(keys, []).get(0)
    if whole is None:
        return []
    total = whole[0]
    targets = {k: total * k / shards for k in range(1, shards)}
    open_ = dict.fromkeys(targets, ((whole[2], LEAST), (whole[3] + 1, LEAST)))
    done: dict[int, Key] = {}
    while open_:
        tried = sorted({p for low, high in open_.values() for p in (low, *spaced(low, high, probes), high) if max(p) <= MOST})
        cells = counted(keys, tried)
        below = list(accumulate(cells.get(i, (0,))[0] for i in range(len(tried))))  # bytes below each probe
        for k in list(open_):
            best = min(range(len(tried)), key=lambda i: abs(below[i] - targets[k]))
            # the target falls into the cell above the last probe that has no more bytes below it
            _, _, h0, h1, t0, t1 = cells[bisect_right(below, targets[k])]
            if abs(below[best] - targets[k]) <= tolerance * total / shards or (h0, t0) == (h1, t1):
                done[k] = tried[best]
                del open_[k]
            elif h0 != h1:
                open_[k] = ((h0, LEAST), (h1 + 1, LEAST))
            else:
                open_[k] = ((h0, t0), (h0, t1 + 1))
    return [done[k] for k in range(1, shards)]


def shard_of(bounds: list[Key]) -> Column:
    shard = F.lit(0)
    for h, t in bounds:
        past = (F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_t") >= t))
        shard = shard + past.cast("int")
    return shard


def sharded(docs: DataFrame, shards: int = 16, tolerance: float = 0.002) -> DataFrame:
    """Add ``size, shard, slot``: shards of near equal bytes, slots from 0 without gaps in each.

    Null texts count 1 byte and are one text. Columns of the input with these names are replaced.
    An empty table stays empty. Only keys and sizes are read while boundaries are sought; the rows,
    with all their columns, move in one exchange.
    """
    keyed = with_keys(docs)
    keys = written(keyed.select("_h", "_t", "_size"), "shard-keys")
    placed = keyed.withColumn("size", F.col("_size")).withColumn("shard", shard_of(splitters(keys, shards, tolerance)))
    order = [F.col("_h"), F.col("_t"), F.col("_doc.doc_id")]
    ranked = numbered(placed, ["shard"], F.struct("_h", "_t"), order, "slot")
    kept = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c not in ("size", "shard", "slot")]
    return ranked.select(*kept, "size", "shard", "slot")
