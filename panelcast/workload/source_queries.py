"""Queries for file trees, JSON documents and sinks; what they read is first derived from the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.operators.conform import conform
from panelcast.operators.report import pending
from panelcast.session import scratch_path
from panelcast.sources.feeds import (
    LIVE_SCHEMA,
    SNAPSHOT_SCHEMA,
    live_points,
    points_table,
    snapshot_entities,
    snapshot_sizes,
    snapshot_teams,
)
from panelcast.sources.sink import done_periods, ordered_parts, read_ranks, write_ordered, write_periods
from panelcast.sources.tree import scan_tree
from panelcast.workload import roles
from panelcast.workload.registry import query
from panelcast.workload.roles import ROLES_SQL, table

PERIOD_FOLDERS = r"/season=([^/]+)/gameweek=(\d+)/[^/]+$"


@query("scan_drifting_headers", ROLES_SQL + """SELECT season, gameweek, id, event_points, minutes,
  CASE WHEN season = '2024-B' THEN total_shots END AS total_shots FROM panel""")
def scan_drifting_headers(spark, sf_dir):
    """Two seasons of CSV files with columns in another order and one column more."""
    panel, root = roles.panel(spark, sf_dir), scratch_path(spark, "panel-tree")
    first, second = roles.SEASONS
    write_periods(panel.where(F.col("season") == first).select("season", "gameweek", "id", "event_points", "minutes"), root, file_format="csv")
    write_periods(panel.where(F.col("season") == second).select("season", "gameweek", "minutes", "total_shots", "id", "event_points"), root, file_format="csv")
    rows = scan_tree(spark, f"{root}/season=*/gameweek=*/*.csv", PERIOD_FOLDERS, required=["id"])
    spec = {"id": "long", "event_points": "double", "minutes": "double", "total_shots": "double"}
    return conform(rows, spec).select("season", "gameweek", *spec)


@query("sink_periods", ROLES_SQL + """SELECT season, gameweek, id,
  CASE WHEN gameweek = 30 THEN minutes + 1 ELSE minutes END AS minutes FROM panel""")
def sink_periods(spark, sf_dir):
    """A second write replaces one period and leaves the others."""
    panel, path = roles.panel(spark, sf_dir).select("season", "gameweek", "id", "minutes"), scratch_path(spark, "panel-table")
    write_periods(panel, path)
    write_periods(panel.where("gameweek = 30").withColumn("minutes", F.col("minutes") + 1), path)
    return spark.read.schema("id long, minutes double, season string, gameweek int").parquet(path)


@query("pending_outputs", ROLES_SQL + "SELECT season, gameweek, id, minutes FROM panel WHERE gameweek > 28 OR season = '2024-A' AND gameweek % 2 = 0")
def pending_outputs(spark, sf_dir):
    """The rows of periods that have no output yet, by the folders of the output itself."""
    panel, path = roles.panel(spark, sf_dir).select("season", "gameweek", "id", "minutes"), scratch_path(spark, "panel-table")
    write_periods(panel.where("gameweek <= 28 AND (season <> '2024-A' OR gameweek % 2 = 1)"), path)
    return pending(panel, done_periods(spark, path), ("season", "gameweek"))


EXPORT_SQL = ROLES_SQL + """, ranked AS (
  SELECT row_number() OVER (ORDER BY predicted_points DESC, gameweek, player_name, team_short) AS rank, * FROM forecasts)
"""
EXPORT_ORDER = (F.desc, "predicted_points"), (F.asc, "gameweek"), (F.asc, "player_name"), (F.asc, "team_short")


def exported(spark, sf_dir):
    path = scratch_path(spark, "export")
    write_ordered(roles.naive_forecasts(spark, sf_dir), path, [direction(c) for direction, c in EXPORT_ORDER])
    return path


@query("export_ranks", EXPORT_SQL + "SELECT * FROM ranked WHERE rank BETWEEN 101 AND 150")
def export_ranks(spark, sf_dir):
    """Fifty ranks of an ordered export, from the files that hold them."""
    schema = "gameweek int, player_name string, team_short string, position string, predicted_points double"
    return read_ranks(spark, exported(spark, sf_dir), schema, 101, 150)


@query("export_parts", EXPORT_SQL + """SELECT count(*) AS "rows", CAST(1 AS BIGINT) AS first_rank, count(*) AS last_rank, CAST(0 AS BIGINT) AS gaps FROM ranked""")
def export_parts(spark, sf_dir):
    """Whether the files of the export, in the order of their names, hold all ranks without a gap."""
    parts = ordered_parts(spark, exported(spark, sf_dir))
    before = F.lag("last_rank", 1, 0).over(Window.orderBy("part"))  # one row a file
    gap = ((F.col("first_rank") != before + 1) | (F.col("rows") != F.col("last_rank") - F.col("first_rank") + 1)).cast("long")
    return parts.withColumn("gap", gap).agg(
        F.sum("rows").alias("rows"), F.min("first_rank").alias("first_rank"), F.max("last_rank").alias("last_rank"), F.sum("gap").alias("gaps"))


def snapshot(spark, sf_dir):
    """Documents with one entity or one team each, parsed back from JSON text."""
    entity = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("web_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("team"),
    )
    team = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("short_name"))
    entities = table(spark, sf_dir, "customer").select(F.to_json(F.struct(F.array(entity).alias("elements"))).alias("doc"))
    teams = table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.array(team).alias("teams"))).alias("doc"))
    return entities.unionByName(teams).select(F.from_json("doc", SNAPSHOT_SCHEMA).alias("d")).select("d.*")


@query("snapshot_sizes", "SELECT (SELECT count(*) FROM customer) AS elements, (SELECT count(*) FROM nation) AS teams")
def sizes(spark, sf_dir):
    return snapshot_sizes(snapshot(spark, sf_dir))


@query("live_points", """SELECT user_id AS player_id, c_name AS player_short_name, n_name AS team_short_name,
  CAST(day(ts) AS INTEGER) AS gameweek, CASE WHEN event_type <> 'click' THEN value END AS event_points
  FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey AND c_acctbal >= 0
  WHERE event_type <> 'error'""")
def live(spark, sf_dir):
    """One live document per event; errors have no elements and clicks no points."""
    stats = F.struct(F.when(F.col("event_type") != "click", F.col("value")).alias("total_points"))
    element = F.struct(F.col("user_id").alias("id"), stats.alias("stats"))
    document = F.when(F.col("event_type") == "error", F.lit("{}")).otherwise(F.to_json(F.struct(F.array(element).alias("elements"))))
    documents = table(spark, sf_dir, "events").select(
        F.dayofmonth("ts").alias("gameweek"), F.from_json(document, LIVE_SCHEMA).alias("d")
    ).select("gameweek", "d.*")
    known = snapshot(spark, sf_dir)
    return points_table(live_points(documents, "gameweek"), snapshot_entities(known), snapshot_teams(known))
