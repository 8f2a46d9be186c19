"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, verified Hamming distances.

A fingerprint is cut into blocks. Two fingerprints with at most ``bits`` differing bits have at
most that many blocks that differ, so they agree on the rest: every choice of that many blocks is a
key, and close pairs meet under at least one. Inside a key all distances are computed, and only a
spanning forest of the links is sent on, never the pairs. A key with too many fingerprints is not
compared as it stands: the bits it leaves free are cut into blocks again, until the free bits alone
bound what a key can hold.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import components, released, shuffle_width, slices
from panelcast.session import written

SEED = 42
#: Most fingerprints compared under one key; a key that leaves 12 bits free can hold no more.
MOST = 4096


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64 bits, each set if it is set in over half the hashes of the word shingles.

    A to Z count as a to z, words are what ASCII white space separates. Fewer words than a shingle
    make one shingle, no word makes 0.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1 :], strict=False)]
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        part = np.array(hashes[start : start + 8192], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, row, fp`` of every row: a hash of the text, and the 64 bits as a signed long."""

    @released
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1 << 20):
                found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("row"), pa.array(found.view(np.int64))], names=["doc_id", "row", "fp"]
                )

    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        compute, f"doc_id {dict(docs.dtypes)['doc_id']}, row long, fp long"
    )


def block_masks(free: int, bits: int) -> list[int]:
    """For each choice of blocks of the ``free`` bits that close pairs may agree on, its bits.

    ``bits + 3`` blocks are cut, so three of them agree.
    """
    at = [i for i in range(64) if free >> i & 1]
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(at, min(bits + 3, len(at)))]
    return [sum(chosen) for chosen in itertools.combinations(blocks, max(0, len(blocks) - bits))]


def spanning_forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of at most ``bits`` bits that connect what all such links connect."""
    parent = np.arange(len(fps))
    links = []
    for start in range(0, len(fps), 256):
        part = fps[start : start + 256]
        near = np.bitwise_count(part[:, None] ^ fps[None, start:]) <= bits
        for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            a, b = start + i, start + j
            while parent[a] != a:
                parent[a] = a = parent[parent[a]]
            while parent[b] != b:
                parent[b] = b = parent[parent[b]]
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(fps[start + i]), int(fps[start + j])))
    return links


def keyed(buckets: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each fingerprint once under every key of its bucket's next blocks: ``mask, key, fp``.

    ``masks`` gives, for the bits a bucket has fixed, the bits its keys fix in all. It depends on
    the level and the number of blocks alone.
    """
    if len(masks) == 1:
        ((_, wider),) = masks.items()
        keys = buckets.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in wider))).alias("mask"))
    else:
        rows = [(fixed, [signed(m) for m in wider]) for fixed, wider in masks.items()]
        table = F.broadcast(buckets.sparkSession.createDataFrame(rows, "mask long, wider array<long>"))
        keys = buckets.select("mask", "fp").join(table, "mask").select("fp", F.explode("wider").alias("mask"))
    return keys.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def compared(rows: DataFrame, bits: int, most: int) -> DataFrame:
    """``a, b`` links inside each key of at most ``most`` fingerprints, and ``mask, key, fp`` of larger keys.

    Rows arrive sorted by key, so a task holds one key at a time and never more of it than ``most``.
    """
    spark = rows.sparkSession
    dealt = rows.repartition(shuffle_width(spark), "mask", "key").sortWithinPartitions("mask", "key", "fp")

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now, size = None, 0

        def batch_of(links, large=()):
            n, k = len(links), len(large)
            return pa.RecordBatch.from_arrays([
                pa.array([*(x[0] for x in links), *[None] * k], pa.int64()), pa.array([*(x[1] for x in links), *[None] * k], pa.int64()),
                pa.array([*[None] * n, *(now[0] for _ in large)], pa.int64()), pa.array([*[None] * n, *(now[1] for _ in large)], pa.int64()),
                pa.array([*[None] * n, *large], pa.int64()),
            ], names=["a", "b", "mask", "key", "fp"])

        def end():
            fps = np.unique(np.concatenate(held)) if held else np.empty(0, np.int64)
            return spanning_forest(fps, bits) if 1 < len(fps) <= most else []

        for batch in batches:
            mask, key, fp = (batch.column(c).to_numpy() for c in ("mask", "key", "fp"))
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            edges = np.r_[starts, len(fp)]
            links: list[tuple[int, int]] = []
            # keys with one row in the middle of a batch cannot hold a link
            busy = np.flatnonzero((np.diff(edges) > 1) | (edges[:-1] == 0) | (edges[1:] == len(fp)))
            for g in busy:
                lo, hi = edges[g], edges[g + 1]
                this = (int(mask[lo]), int(key[lo]))
                if this != now:
                    links += end()
                    held, now, size = [], this, 0
                size += hi - lo
                if size <= most:
                    held.append(fp[lo:hi].copy())
                else:  # too large: all of it goes on to finer keys
                    yield batch_of([], np.concatenate([*held, fp[lo:hi]]).tolist())
                    held = []
            if links:
                yield batch_of(links)
        if held and size <= most and (links := end()):
            yield batch_of(links)

    return dealt.mapInArrow(compare, "a long, b long, mask long, key long, fp long")


def linked(distinct: DataFrame, bits: int = 4, most: int = MOST) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints ``fp`` at most ``bits`` bits apart.

    ``distinct`` holds each fingerprint once, so equal documents, however many, are one row here.
    """
    most = max(most, 1 << bits)
    links, everything = None, (1 << 64) - 1
    buckets = distinct.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("key"), "fp")
    fixed = [0]
    while True:
        masks = {signed(f): [f | m for m in block_masks(everything & ~f, bits)] for f in fixed}
        found = written(compared(keyed(buckets, masks), bits, most), "simhash")
        new = found.filter("a IS NOT NULL").select("a", "b")
        links = new if links is None else links.union(new)
        buckets = found.filter("a IS NULL").select("mask", "key", "fp")
        fixed = [r.mask & everything for r in buckets.select("mask").distinct().collect()]
        if not fixed:
            return links


def classes(prints: DataFrame, bits: int) -> DataFrame:
    """``fp, root, component_id`` of every fingerprint: the root names its component, whatever the ids are."""
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(linked(smallest.select("fp"), bits))
    rooted = smallest.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(named, "root")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Documents whose fingerprints differ in at most ``bits`` bits are linked; ``component_id`` is the
    smallest ``doc_id`` that links reach. Null, empty and wordless texts have fingerprint 0 and are
    linked like any other. Rows that share a ``doc_id`` are fingerprinted each for itself; a null
    ``doc_id`` is never a component's name unless nothing else is in it. No rows give no rows.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    return prints.join(classes(prints, bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest ``doc_id``.

    Components are told apart by their fingerprints, so rows without an id, or with one id in
    several components, lose nothing: a component whose ids are all null keeps one row. Of rows of a
    component that share the smallest id the one with the smallest text hash stays, and of rows with
    that id and text the one whose other columns hash smallest.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    chosen = prints.join(classes(prints, bits), "fp").groupBy("root").agg(F.min(place).alias("first")).select(
        F.xxhash64("first.doc_id").alias("id_hash"), F.col("first.row").alias("text_hash")
    )
    rows = docs.select(  # the whole row in one column, so that none of its own clashes
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash")
    )
    once = Window.partitionBy("id_hash", "text_hash").orderBy(F.xxhash64("doc"))  # as dealt for the join
    kept = rows.join(chosen, ["id_hash", "text_hash"], "left_semi").withColumn("rank", F.row_number().over(once)).filter("rank = 1")
    return kept.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
