"""Pairings: one row per match becomes one row per side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.text import contains_ignoring_case
from panelcast.operators.conform import lenient

PAIR_TYPES = {"home_team": "long", "away_team": "long", "home_team_elo": "double", "away_team_elo": "double"}


def keep_competition(df: DataFrame, needle: str = "prem", columns: Sequence[str] = ("tournament", "match_id")) -> DataFrame:
    """Keep the matches whose first present column of ``columns`` holds ``needle``; without any, keep all."""
    for name in columns:
        if name in df.columns:
            return df.where(contains_ignoring_case(F.col(name).cast("string"), needle))
    return df


def team_rows(
    df: DataFrame,
    keep: Sequence[str] = ("season", "gameweek"),
    team: str = "team_code",
    opponent: str = "opp_code",
) -> DataFrame:
    """A home row and an away row per match, with codes and ratings swapped, from one scan.

    Rows in which either code is missing are dropped.
    """
    df = lenient(df, PAIR_TYPES)

    def side(us: str, them: str, is_home: int):
        return F.struct(
            F.col(f"{us}_team").alias(team),
            F.col(f"{them}_team").alias(opponent),
            F.lit(is_home).cast("int").alias("is_home"),
            F.col(f"{us}_team_elo").alias("team_elo"),
            F.col(f"{them}_team_elo").alias("opp_elo"),
        )

    complete = df.na.drop(subset=["home_team", "away_team"])
    return complete.select(*keep, F.inline(F.array(side("home", "away", 1), side("away", "home", 0))))
