"""Correct zero targets from a second source and keep the old value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.conform import with_absent_as_null
from panelcast.operators.snapshot import latest_season
from panelcast.sources.versions import Change, Version, commit


def first_corrections(sources: DataFrame, entity: str = "id", period: str = "gameweek", value: str = "event_points", file: str = "file_name") -> DataFrame:
    """One row per key: ``api_points`` and ``has_api``.

    ``api_points`` is the first positive value by file name, cut to an integer. A value below 1 is cut
    to 0 and leaves the target open for the next file, so it only counts when no file has more.
    """
    points = F.col(value).cast("double")
    positive = F.when(points > 0, F.struct((points < 1).alias("below_one"), F.col(file).alias("file"), points.alias("points")))
    return sources.where(points.isNotNull()).groupBy(entity, period).agg(
        F.min(positive)["points"].cast("long").cast("double").alias("api_points"),
        F.lit(True).alias("has_api"),
    )


def patch_zero_targets(
    panel: DataFrame,
    sources: DataFrame,
    season: str = "season",
    entity: str = "id",
    period: str = "gameweek",
    target: str = "event_points",
    original: str = "event_points_orig",
) -> tuple[DataFrame, DataFrame]:
    """(patched panel, counts per period with a total row).

    Only the latest season is joined and changes, and there only targets of 0 with a positive second value. The old
    value goes to ``original``; where nothing changes it keeps what it held. The join is by key, and
    the second source is first reduced to one row per key, so the panel never fans out.
    """
    panel = with_absent_as_null(panel, {original: "double"})
    newest = panel.agg(F.max(season)).scalar()
    fixes = first_corrections(sources, entity, period, target)
    open_ = panel.where(F.col(season) == newest)
    joined = open_.join(fixes, [entity, period], "left").withColumn(
        "_patch", F.coalesce((F.col(target) == 0) & (F.col("api_points") >= 0), F.lit(False))
    )
    patched = joined.withColumns({
        original: F.when(F.col("_patch"), F.col(target)).otherwise(F.col(original)),
        target: F.when(F.col("_patch"), F.col("api_points")).otherwise(F.col(target)),
    }).select(*panel.columns)
    closed = panel.where(~F.col(season).eqNullSafe(newest))
    counts = (
        joined.rollup(period)
        .agg(
            F.count_if(F.col("has_api")).alias("with_second_source"),
            F.count_if(F.col("_patch")).alias("updated"),
        )
    )
    return closed.unionByName(patched), counts


def changed_periods(
    panel: DataFrame,
    sources: DataFrame,
    season: str = "season",
    entity: str = "id",
    period: str = "gameweek",
    target: str = "event_points",
) -> DataFrame:
    """The ``season, period`` of the rows of ``panel`` that a patch would change: zeros with a positive second value."""
    fixes = first_corrections(sources, entity, period, target).where("api_points >= 0")
    return panel.where(F.col(target) == 0).join(fixes, [entity, period], "left_semi").select(season, period).distinct()


def patch_version(
    base: Version,
    sources: DataFrame,
    table: str = "panel",
    season: str = "season",
    entity: str = "id",
    period: str = "gameweek",
    target: str = "event_points",
    original: str = "event_points_orig",
) -> Version:
    """Patch a versioned table, partitioned by season and period, and publish the next version.

    Of the latest season the periods with something to change are found first; only they are read
    whole, patched and written, all others keep their folders. Without any, ``base`` is returned.
    """
    places = base.places(table)
    newest = max((p[season] for p in places if p[season] is not None), default=None)
    panel = base.table(table)
    latest = panel.where(F.col(season) == newest)
    changed = [r[period] for r in changed_periods(latest, sources, season, entity, period, target).collect()]  # periods of one season
    if not changed:
        return base
    rows, _ = patch_zero_targets(latest.where(F.col(period).isin(changed)), sources, season, entity, period, target, original)
    return commit(base, {table: Change(rows, (season, period))})


def season_rows(panel: DataFrame, season: str = "season") -> DataFrame:
    """One row: how many rows the latest season has."""
    return latest_season(panel, season).agg(F.count(F.lit(1)).alias("rows"))
