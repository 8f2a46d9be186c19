"""Number rows in a total order and cut them into blocks with a halo, so that ROWS windows over a very
large group, or over the whole table, run in many tasks.

A frame of ``width`` rows needs only the ``width`` rows before it. Rows get a position in the total
order, position // block_rows is their block, and each block also receives the last ``width`` rows of
the block before it. Windows then run per block and the copies are dropped. The result is exact and no
task holds more than ``block_rows + width`` rows of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.session import checked_broadcast, written

# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
_LOCAL_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: Sequence[str], name: str = "_row") -> DataFrame:
    """Add each row's position (from 0) in the order of ``order``, which must have no ties.

    The range-partitioned rows are written out once: the partition sizes and the rows are read from
    the same files, so positions cannot shift between the two reads or when a task runs again.
    """
    placed = written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))),
        "numbered",
    )
    # One row per partition, so this window without partitions and the broadcast stay small.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(checked_broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_part", "_local", "_start")
    )


def with_halo(numbered: DataFrame, width: int, block_rows: int, row: str = "_row") -> DataFrame:
    """Add ``_block`` and ``_copy``; the last ``width`` rows of a block also appear in the next one."""
    if block_rows < width:
        raise ValueError(f"a block must hold at least the {width} rows of the widest frame")
    block = F.floor(F.col(row) / block_rows).cast("long")
    is_tail = F.pmod(F.col(row), F.lit(block_rows)) >= block_rows - width
    own = F.struct(block.alias("_block"), F.lit(False).alias("_copy"))
    handed_on = F.struct((block + 1).alias("_block"), F.lit(True).alias("_copy"))
    return numbered.select("*", F.inline(F.when(is_tail, F.array(own, handed_on)).otherwise(F.array(own))))
