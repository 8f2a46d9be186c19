"""Nested JSON documents with lists of entities and teams, already landed as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_SCHEMA = (
    "elements array<struct<id: bigint, web_name: string, team: bigint>>, "
    "teams array<struct<id: bigint, short_name: string>>"
)
LIVE_SCHEMA = "elements array<struct<id: bigint, stats: struct<total_points: double>>>"


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file; a document without a field has null there."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def snapshot_entities(snapshot: DataFrame) -> DataFrame:
    """player_id, player_short_name, team_id."""
    element = snapshot.select(F.explode("elements").alias("e"))
    return element.select(
        F.col("e.id").alias("player_id"), F.col("e.web_name").alias("player_short_name"), F.col("e.team").alias("team_id")
    )


def snapshot_teams(snapshot: DataFrame) -> DataFrame:
    """team_id, team_short_name."""
    team = snapshot.select(F.explode("teams").alias("t"))
    return team.select(F.col("t.id").alias("team_id"), F.col("t.short_name").alias("team_short_name"))


def snapshot_sizes(snapshot: DataFrame) -> DataFrame:
    """How many entities and teams the documents list."""
    return snapshot.agg(*[
        F.coalesce(F.sum(F.coalesce(F.array_size(c), F.lit(0))), F.lit(0)).alias(c) for c in ("elements", "teams")
    ])


def live_points(live: DataFrame, *keep: str) -> DataFrame:
    """player_id and event_points of each listed entity, plus columns to keep of the document."""
    element = live.select(*keep, F.explode("elements").alias("e"))
    return element.select(*keep, F.col("e.id").alias("player_id"), F.col("e.stats.total_points").alias("event_points"))


def points_table(points: DataFrame, entities: DataFrame, teams: DataFrame) -> DataFrame:
    """player_id, player_short_name, team_short_name, gameweek, event_points; unknown names are null.

    The two lists are joined first, so the points are joined once.
    """
    named = entities.join(teams, ["team_id"], "left")
    return points.join(named, ["player_id"], "left").select("player_id", "player_short_name", "team_short_name", "gameweek", "event_points")
