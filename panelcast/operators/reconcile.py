"""Join two tables whose keys differ in case and accents, directly or by resolved ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.text import comparison_key
from panelcast.operators.conform import conform, require, resolve_alias
from panelcast.operators.keys import with_known_keys
from panelcast.operators.report import with_errors
from panelcast.operators.snapshot import latest_season

NAME_KEYS = ("player_name", "team_short")
FORECAST_COLUMNS = ("gameweek", "player_name", "team_short", "position", "predicted_points")


# Other names under which actuals tables hold the id and the target.
ID_ALIASES = ("player_id", "element", "playerId")
TARGET_ALIASES = ("total_points", "gw_points", "points")


def prepare_actuals(df: DataFrame, period: str = "gameweek", target: str = "event_points") -> DataFrame:
    """The rows of the latest season with id, period and target under their usual names and types."""
    df = require(df, ["season", period])
    df = resolve_alias(resolve_alias(df, "id", ID_ALIASES), target, TARGET_ALIASES)
    return latest_season(conform(df, {"season": "string", period: "int", "id": "long", target: "double"}))


def with_comparison_keys(df: DataFrame, columns: Sequence[str] = NAME_KEYS, prefix: str = "_key_", known: DataFrame | None = None) -> DataFrame:
    """Add the comparison key of each column, in one pass of the Arrow function over the rows.

    With ``known``, a dictionary of names and keys that holds all of them, keys are joined instead.
    """
    if known is not None:
        return with_known_keys(df, known, columns, prefix)
    return df.withColumns({f"{prefix}{c}": comparison_key(F.col(c)) for c in columns})


@dataclass(frozen=True)
class Resolution:
    """Forecasts left-joined to ids, and the forecasts whose name fits several ids (one row per id)."""

    joined: DataFrame
    ambiguous: DataFrame
    entity: str = "id"

    @property
    def resolved(self) -> DataFrame:
        return self.joined.where(F.col(self.entity).isNotNull())

    @property
    def unresolved(self) -> DataFrame:
        return self.joined.where(F.col(self.entity).isNull()).drop(self.entity)

    def samples(self, n: int = 10) -> DataFrame:
        """A few unresolved names for the report."""
        return self.unresolved.select(*NAME_KEYS).orderBy(*NAME_KEYS).limit(n)

    def counts(self) -> DataFrame:
        """Rows by outcome; ambiguous forecasts are among the resolved ones."""
        found = F.when(F.col(self.entity).isNull(), F.lit("unresolved")).otherwise(F.lit("resolved"))
        outcomes = self.joined.select(found.alias("outcome")).unionByName(
            self.ambiguous.select(F.lit("ambiguous").alias("outcome"))
        )
        return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


def resolve_ids(forecasts: DataFrame, names: DataFrame, entity: str = "id", known: DataFrame | None = None) -> Resolution:
    """Attach ids to forecasts by (name, team) without regard to case and accents; null never matches."""
    keys = [f"_key_{c}" for c in NAME_KEYS]
    forecasts = with_comparison_keys(forecasts, known=known)
    lookup = with_comparison_keys(names, known=known).select(*keys, F.col("player_id").alias(entity)).na.drop()
    joined = forecasts.join(lookup, keys, "left").drop(*keys)
    several = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ids")).where(F.col("_ids") > 1)
    return Resolution(joined, forecasts.join(several, keys, "left_semi").drop(*keys), entity)


def reconcile_direct(
    forecasts: DataFrame, actuals: DataFrame, period: str = "gameweek", target: str = "event_points", known: DataFrame | None = None
) -> DataFrame:
    """Inner join by period and names without case and accents."""
    keys = [f"_key_{c}" for c in NAME_KEYS]
    right = with_comparison_keys(actuals, known=known).select(period, *keys, "season", "id", target)
    return with_comparison_keys(forecasts, known=known).join(right, [period, *keys]).drop(*keys)


def reconcile_by_id(forecasts: DataFrame, actuals: DataFrame, period: str = "gameweek", target: str = "event_points") -> DataFrame:
    """Inner join by period and id."""
    return forecasts.join(actuals.select(period, "id", "season", target), [period, "id"])


def period_routes(forecasts: DataFrame, direct: DataFrame, min_ratio: float = 0.7, period: str = "gameweek") -> DataFrame:
    """Per period: forecasts, direct matches and whether the direct route covers enough of them."""
    wanted = forecasts.groupBy(period).agg(F.count(F.lit(1)).alias("forecasts"))
    matched = direct.groupBy(period).agg(F.count(F.lit(1)).alias("matched"))
    enough = F.greatest(F.lit(1), F.floor(F.col("forecasts") * min_ratio))
    return (
        wanted.join(matched, [period], "left")
        .withColumn("matched", F.coalesce("matched", F.lit(0)))
        .withColumn("direct", F.col("matched") >= enough)
    )


def reconcile(
    forecasts: DataFrame,
    actuals: DataFrame,
    names: DataFrame,
    min_ratio: float = 0.7,
    period: str = "gameweek",
    target: str = "event_points",
    known: DataFrame | None = None,
) -> DataFrame:
    """Forecasts next to what happened, with errors.

    A period uses the direct join where it matches at least ``min_ratio`` of the forecasts, else ids
    resolved by name. Without name columns in ``actuals``, every period goes by id. All of it is one
    plan: the direct join is counted and used through the same exchanges, and no job runs before the
    result is asked for. ``known`` is a dictionary of the names' keys (see ``keys.extended``); without
    it every row's names are folded.
    """
    require(forecasts, FORECAST_COLUMNS)
    if not set(NAME_KEYS) <= set(actuals.columns):
        merged = reconcile_by_id(resolve_ids(forecasts, names, known=known).resolved, actuals, period, target)
    else:
        direct = reconcile_direct(forecasts, actuals, period, target, known)
        routes = period_routes(forecasts, direct, min_ratio, period)
        by_name = routes.where("direct").select(period)
        by_id = routes.where("not direct").select(period)
        rest = resolve_ids(forecasts.join(by_id, [period], "left_semi"), names, known=known).resolved
        merged = direct.join(by_name, [period], "left_semi").unionByName(
            reconcile_by_id(rest, actuals, period, target)
        )
    columns = ["season", period, "id", "player_name", "team_short", "position", "predicted_points", target]
    return with_errors(merged.select(*columns), "predicted_points", target)
