"""Tables stored as joins and windows want them dealt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: A bucket is read by one task, so it should fit one: take some 100 MB of a table for each.
BUCKETS = 64


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str] = ("season", "id"), order: Sequence[str] = ("gameweek",), buckets: int = BUCKETS
) -> DataFrame:
    """Store ``df`` as the table ``name`` at ``path``, dealt by ``keys`` and sorted by them and ``order``.

    The rows are dealt once, here: one task writes one bucket as one file. Joins and windows by these keys
    over tables with the same number of buckets then plan no exchange.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def one_file_each(spark: SparkSession, name: str, buckets: int = BUCKETS) -> bool:
    """Whether no bucket has more than one file, as when the table was written in one go; only then is its order of use."""
    return len(spark.table(name).inputFiles()) <= buckets
