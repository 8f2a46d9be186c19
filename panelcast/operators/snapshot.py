"""The state of each entity at the end of its history, and the rows of the period to come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.functions.features import reached
from panelcast.operators.conform import percent_columns, with_absent_as_null
from panelcast.operators.enrich import attach_context

SNAPSHOT_COLUMNS = ("now_cost", "selected_by_percent", "form")


def latest_season(df: DataFrame, season: str = "season") -> DataFrame:
    """The rows of the greatest season label; the label is a scalar subquery of the same plan."""
    return df.where(F.col(season) == df.agg(F.max(season)).scalar())


def last_period(df: DataFrame, season: str = "season", period: str = "gameweek") -> DataFrame:
    """One row: the latest season, its last period and the next one, in a single pass."""
    newest = df.agg(F.max(F.struct(season, period)).alias("_newest"))
    return newest.select(
        F.col("_newest")[season].alias(season),
        F.col("_newest")[period].alias("last_gw"),
        (F.col("_newest")[period] + 1).alias("next_gw"),
    )


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1, rank: str = "_rank") -> DataFrame:
    """Each entity's ``n`` latest rows with ``rank`` 1 for the newest.

    Spark keeps at most ``n`` rows per entity in each map task before the shuffle.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn(rank, F.row_number().over(newest)).where(F.col(rank) <= n)


def current_form(
    df: DataFrame,
    keys: Sequence[str] = ("season", "id"),
    order: Sequence[str] = ("gameweek",),
    snapshot: Sequence[str] = SNAPSHOT_COLUMNS,
    tail: int = 3,
    minutes_needed: float = 60,
) -> DataFrame:
    """One row per entity: values of its latest row and means over its last ``tail`` rows.

    The latest row may lie before the last period, and a null in it stays null.
    """
    df = with_absent_as_null(df, dict.fromkeys(snapshot, "string"))
    rows = latest_rows(df.select(*keys, *order, "event_points", "minutes", *snapshot), keys, order, tail)

    def newest(column: str) -> Column:
        return F.max(F.when(F.col("_rank") == 1, F.col(column)))

    return rows.groupBy(*keys).agg(
        newest("event_points").alias("pts_prev_gw"),
        F.avg("event_points").alias(f"pts_avg_last{tail}"),
        F.avg("minutes").alias(f"mins_avg_last{tail}"),
        F.avg(reached(F.col("minutes"), minutes_needed)).alias(f"played60_rate_last{tail}"),
        *[newest(c).alias(c) for c in snapshot],
    )


def next_period_rows(
    panel: DataFrame,
    members: DataFrame,
    fixtures: DataFrame,
    strengths: DataFrame,
    season: str | None = None,
    last_gw: int | None = None,
) -> DataFrame:
    """Feature rows for the period after ``last_gw``: one per entity and fixture of its team.

    ``season`` and ``last_gw`` default to the latest ones of the panel. They are the only values read
    on the driver, so that season and period reach the scans as literals and prune partitions.
    """
    if season is None or last_gw is None:
        newest = last_period(panel if season is None else panel.where(F.col("season") == season)).first()
        season, last_gw = newest["season"], newest["last_gw"] if last_gw is None else last_gw
    history = panel.where((F.col("season") == season) & (F.col("gameweek") <= last_gw))
    upcoming = fixtures.where((F.col("season") == season) & (F.col("gameweek") == last_gw + 1))
    rows = current_form(history).withColumn("gameweek", F.lit(last_gw + 1).cast("int"))
    rows = attach_context(rows, members, upcoming, strengths)
    return percent_columns(rows.where(F.col("is_home").isNotNull()), SNAPSHOT_COLUMNS)


def sum_by_entity(forecasts: DataFrame, keys: Sequence[str] = ("season", "gameweek", "id"), value: str = "predicted_points") -> DataFrame:
    """Add up the forecasts of an entity that plays more than once in the period."""
    return forecasts.groupBy(*keys).agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("fixtures"))
