"""Forecast errors and the data behind error plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    """One row: the number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def with_errors(df: DataFrame, predicted: str = "predicted_points", actual: str = "event_points") -> DataFrame:
    """Add ``error`` (forecast minus actual) and ``abs_error``."""
    error = F.col(predicted) - F.col(actual)
    return df.withColumns({"error": error, "abs_error": F.abs(error)})


def mean_absolute_error(df: DataFrame, by: Sequence[str] = (), predicted: str = "predicted_points", actual: str = "event_points") -> DataFrame:
    """``mae`` and ``rows`` per group; rows without a forecast or an actual do not count."""
    error = F.abs(F.col(predicted) - F.col(actual))
    return df.groupBy(*by).agg(F.avg(error).alias("mae"), F.count(error).alias("rows"))


def worst_first(df: DataFrame, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("abs_error"), *tie)


def by_team_worst_first(df: DataFrame, tie: Sequence[str], team: str = "team_short") -> DataFrame:
    return df.orderBy(F.asc_nulls_last(team), F.desc_nulls_last("abs_error"), *tie)


def axis_limits(
    df: DataFrame, by: Sequence[str] = ("gameweek", "team_short"), x: str = "predicted_points", y: str = "event_points", pad: float = 0.5
) -> DataFrame:
    """``lo`` and ``hi`` per group, padded and rounded outwards; without points, 0 and 1 stand in."""
    low = F.least(F.coalesce(F.min(x), F.lit(0.0)), F.coalesce(F.min(y), F.lit(0.0)))
    high = F.greatest(F.coalesce(F.max(x), F.lit(1.0)), F.coalesce(F.max(y), F.lit(1.0)))
    return df.groupBy(*by).agg(
        F.floor(low - pad).cast("long").alias("lo"), F.ceil(high + pad).cast("long").alias("hi")
    )


def scatter_points(
    df: DataFrame,
    by: Sequence[str] = ("gameweek", "team_short"),
    label: str = "player_name",
    x: str = "predicted_points",
    y: str = "event_points",
) -> DataFrame:
    """One row per point with the limits of its plot; ``lo`` and ``hi`` also end the y = x line.

    A group never has more limits than one row, so the limits join back by broadcast or shuffle as
    their size allows, and no group is collected. Rows without a team belong to no plot.
    """
    points = df.na.drop(subset=list(by))
    return points.join(axis_limits(points, by, x, y), list(by)).select(*by, label, x, y, "lo", "hi")


def pending(df: DataFrame, done: DataFrame, by: Sequence[str] = ("gameweek",)) -> DataFrame:
    """The rows of periods that are not done yet."""
    return df.join(done.select(*by).distinct(), list(by), "left_anti")
