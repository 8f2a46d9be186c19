"""What several corpus operators share: reading tables, ranks without a hot task, components."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.session import written

PairRows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released(function: PairRows) -> PairRows:
    """A function over batches that gives the memory of its batches back at its end.

    A worker process lives on and serves the next tasks; what Arrow keeps for later would add up to
    over 100 MB in each.
    """

    @functools.wraps(function)
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return tidy


def slices(batch: pa.RecordBatch, most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, ``most`` bytes of text at a time but one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
    start, ends = 0, np.cumsum(sizes)
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, group: list[str], spread: Column, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    Rows are spread over cells by a hash, numbered inside their cell, and moved up by the rows of
    the cells before it. Which row of a group gets which number is fixed by the rows alone.
    """
    cells = 4 * shuffle_width(df.sparkSession)
    groups = [F.col(c).alias(f"_group{i}") for i, c in enumerate(group)]
    orders = [c.alias(f"_order{i}") for i, c in enumerate(order)]
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")  # its columns clash with nothing here
    cell = df.select(row, *groups, *orders, F.pmod(F.xxhash64(spread), F.lit(cells)).cast("int").alias("_cell"))
    keys = [*(f"_group{i}" for i in range(len(group))), "_cell"]
    counts = cell.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys[:-1]).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*(f"_order{i}" for i in range(len(order))))
    ranked = cell.withColumn("_inside", F.row_number().over(inside).cast("long") - 1).join(starts, keys)
    columns = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != name]
    return ranked.select(*columns, (F.col("_before") + F.col("_inside")).alias(name))


def in_few_files(df: DataFrame, rows: int, each: int = 500_000) -> DataFrame:
    """``df``, which has no more than about ``rows`` rows, in one task for every ``each`` of them, or fewer.

    Where few rows come out of many shuffle partitions, a written table is not hundreds of small files;
    the number of tasks still grows with the rows.
    """
    return df.coalesce(max(1, -(-rows // each)))


#: A group with more than one in this many of all rows counts as hot; there are fewer of them.
HOT_SHARE = 1000


def grouped_rows(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their group, the one row of ``groups`` with their ``keys``; others go.

    ``groups`` has the number of rows of each group as ``n``, which is not passed on, and both are
    written tables, as they are read twice. Hot groups, fewer than ``HOT_SHARE``, are broadcast, so
    their rows stay where they are; the others are joined by shuffle, none too large for a task.
    """
    least = rows.count() // HOT_SHARE
    hot, cold = (groups.filter(c).drop("n") for c in (F.col("n") > least, F.col("n") <= least))
    hot = F.broadcast(hot)
    far = rows.join(hot.select(*keys), keys, "left_anti").join(cold.hint("merge"), keys)
    return rows.join(hot, keys).unionByName(far)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)`` as ``(node, root)``; root is the smallest node.

    Large-star and small-star steps in turn: each joins every node's neighbours to its smallest
    one, once for the larger and once for the smaller neighbours, until each node hangs directly
    below its root. Every step is a grouped minimum and an equi-join, so no component is gathered,
    and each round is a written table that a lost executor cannot take along.
    """
    links = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while True:
        # every node's neighbours larger than it go to its smallest neighbour (or itself)
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every node's smaller neighbours, and the node, go to its smallest neighbour
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a <> b").distinct()
        after = written(small, "links")
        # finished when every node has one link and no root is itself below another node
        tops = after.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        deep = after.select(F.col("b").alias("a")).distinct().join(after.select("a").distinct(), "a", "left_semi")
        if tops.filter("n > 1").isEmpty() and deep.isEmpty():
            roots = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        links = after
