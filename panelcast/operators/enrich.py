"""Attach dimensions and fixtures to panel rows.

No join here starts a job. Team and fixture tables are left to the optimizer, which broadcasts a side whose
files are known to be small, and where only the running query can tell, adaptive execution does, by the bytes
that side has come to. Entity maps grow with the entities, and few compressed bytes of them fill hundreds of
megabytes as a hash table; they are merged, in the partitioning and order of the rolling windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.features import opponent_strength
from panelcast.operators.counted import Counts


def left_lookup(df: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_right") -> DataFrame:
    """Left join on equal column names; other columns of ``right`` that clash get ``suffix``."""
    clashes = {c: f"{c}{suffix}" for c in right.columns if c in df.columns and c not in on}
    right = right.withColumnsRenamed(clashes)
    return df.join(right, list(on), "left")


def attach_team(df: DataFrame, members: DataFrame, season: str = "season", entity: str = "id", member: str = "player_id") -> DataFrame:
    """Add each entity's team of the season; an unknown entity gets null."""
    teams = members.select(season, F.col(member).alias(entity), "team_code")
    return left_lookup(df, teams.hint("merge"), [season, entity])


def attach_fixtures(df: DataFrame, fixtures: DataFrame, on: Sequence[str] = ("season", "gameweek", "team_code")) -> DataFrame:
    """Add the team's fixtures of the period. Two fixtures give two rows, none gives one row of nulls."""
    return left_lookup(df, fixtures, on, suffix="_fixture")


def attach_opponent_strength(df: DataFrame, strengths: DataFrame, season: str = "season", opponent: str = "opp_code") -> DataFrame:
    """Add the opponent's strengths and the one that counts for this fixture."""
    lookup = strengths.select(
        season,
        F.col("team_code").alias(opponent),
        F.col("strength_defence_home").alias("opp_strength_defence_home"),
        F.col("strength_defence_away").alias("opp_strength_defence_away"),
    )
    joined = left_lookup(df, lookup, [season, opponent])
    return joined.withColumn(
        "opp_def_strength",
        opponent_strength(F.col("is_home"), F.col("opp_strength_defence_home"), F.col("opp_strength_defence_away")),
    )


def attach_context(df: DataFrame, members: DataFrame, fixtures: DataFrame, strengths: DataFrame, counts: Counts | None = None) -> DataFrame:
    """Team, fixture and opponent strength in one step.

    ``counts`` gets the rows without a team, and after the fixtures have fanned out those without one,
    and those with a fixture but no strength.
    """
    counts = counts or Counts()
    with_team = counts.at(attach_team(df, members), {"rows": F.lit(True), "without_team": F.col("team_code").isNull()})
    with_fixture = counts.at(attach_fixtures(with_team, fixtures), {"fixture_rows": F.lit(True), "without_fixture": F.col("opp_code").isNull()})
    return counts.at(attach_opponent_strength(with_fixture, strengths), {
        "without_strength": F.col("opp_code").isNotNull() & F.col("opp_def_strength").isNull(),
    })


def entity_names(members: DataFrame, teams: DataFrame, season: str = "season") -> DataFrame:
    """season, player_id, player_name, team_short, position; missing names stay null."""
    shorts = teams.select(season, "team_code", "team_short")
    named = left_lookup(members, shorts, [season, "team_code"])
    return named.select(
        season,
        F.col("player_id").cast("long").alias("player_id"),
        F.col("web_name").cast("string").alias("player_name"),
        F.col("team_short").cast("string").alias("team_short"),
        F.col("position").cast("string").alias("position"),
    )


def attach_names(df: DataFrame, names: DataFrame, season: str = "season", entity: str = "id") -> DataFrame:
    """Add readable names; the key has another name on the right side."""
    return left_lookup(df, names.withColumnRenamed("player_id", entity).hint("merge"), [season, entity])
