"""Leaderboards. Every order ends in a tie-break, so a result never depends on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_overall(df: DataFrame, value: str, tie: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` rows with the greatest value."""
    return df.orderBy(F.desc_nulls_last(value), *tie).limit(n)


def top_by_group(
    df: DataFrame, group: str, value: str, tie: Sequence[str], n: int = 10, groups: Sequence[str] | None = None, rank: str = "rank"
) -> DataFrame:
    """The ``n`` greatest rows of each group with their rank; ``groups`` selects and orders the groups.

    Spark cuts each map task to ``n`` rows per group before the shuffle, so a large group stays cheap.
    """
    best_first = W.partitionBy(group).orderBy(F.desc_nulls_last(value), *tie)
    if groups is not None:
        df = df.where(F.col(group).isin(list(groups)))
    ranked = df.withColumn(rank, F.row_number().over(best_first)).where(F.col(rank) <= n)
    if groups is None:
        return ranked.orderBy(group, rank)
    return ranked.orderBy(F.array_position(F.array(*map(F.lit, groups)), F.col(group)), rank)


def first_periods(df: DataFrame, n: int = 20, season: str = "season", period: str = "gameweek") -> DataFrame:
    """The first ``n`` distinct periods of each season."""
    early = W.partitionBy(season).orderBy(period)
    distinct = df.select(season, period).distinct()
    return distinct.withColumn("_n", F.row_number().over(early)).where(F.col("_n") <= n).drop("_n").orderBy(season, period)


def sorted_distinct(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct values that are not missing, in order."""
    return df.select(*columns).na.drop().distinct().orderBy(*columns)
