"""Queries over a file tree laid out by season and period, with one CSV file per table and period.

The tree is derived from the tables: ``<season>/By Gameweek/GW<n>/…`` for the panel and the matches,
``<season>/players.csv`` and ``teams.csv``, and ``predictions/gw<n>_predictions.csv``. Next to them lie
what a scan has to cope with: a folder that is no period, an empty file, files without ratings, and
teams without a code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.counted import Counts
from panelcast.operators.pairs import PAIR_TYPES
from panelcast.operators.patch import patch_version
from panelcast.operators.reconcile import reconcile
from panelcast.plans.model_table import engineered, model_table
from panelcast.session import SCRATCH, scratch_path
from panelcast.sources import tree, versions
from panelcast.sources.elements import read_elements
from panelcast.sources.feeds import LIVE_SCHEMA, live_points
from panelcast.sources.sink import CSV_WRITE_OPTIONS, write_periods
from panelcast.workload import roles
from panelcast.workload.registry import query
from panelcast.workload.report_queries import PATCH_SQL, zeroed_panel
from panelcast.workload.roles import ROLES_SQL, rounded, table

ROOTS: dict[tuple[str, str], str] = {}


def write_files(df: DataFrame, path: Column, root: str) -> None:
    """One CSV file with a header for each value of ``path``, in one job and one rename a file."""
    spark, scratch = df.sparkSession, scratch_path(df.sparkSession, "files")
    numbered = df.withColumn("_path", path).withColumn("_file", F.xxhash64("_path"))
    names = {r["_file"]: r["_path"] for r in numbered.select("_file", "_path").distinct().collect()}
    numbered.drop("_path").repartition("_file").write.partitionBy("_file").options(**CSV_WRITE_OPTIONS).csv(scratch)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    to_path = jvm.org.apache.hadoop.fs.Path
    files = to_path(scratch).getFileSystem(conf)
    for number, name in names.items():
        part = files.globStatus(to_path(f"{scratch}/_file={number}/part-*"))[0].getPath()
        target = to_path(f"{root}/{name}")
        files.mkdirs(target.getParent())
        files.rename(part, target)


def write_corrections(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``actual-points/gw<n>-points.csv`` with repeated keys, some of them in two files, next to files of other names."""
    events, day = table(spark, sf_dir, "events"), F.dayofmonth("ts")
    points = events.select(
        F.col("user_id").alias("player_id"), day.alias("gameweek"), F.round(F.col("value") - 5, 2).alias("event_points"),
        F.concat(F.lit("actual-points/gw"), F.when(F.col("event_type") == "view", day % 20 + 1).otherwise(day), F.lit("-points.csv")).alias("file"),
    )
    write_files(points, F.col("file"), root)
    stranger = points.where("gameweek < 4").drop("file").withColumn("event_points", F.lit(777.0))
    write_files(stranger, F.lit("actual-points/xgw3-points.csv"), root)
    write_files(stranger, F.lit("actual-points/gw3-points.old.csv"), root)


def write_documents(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``snapshot`` with one JSON document of all members, an element a line, and ``live`` with a document of points a period."""
    members = roles.members(spark, sf_dir).where(F.col("season") == roles.CURRENT)
    least = members.agg(F.min("player_id")).first()[0]
    element = F.to_json(F.struct(F.col("player_id").alias("id"), F.concat("web_name", F.lit(" }{\"")).alias("web_name"), F.col("team_code").alias("team")))
    lines = members.select(F.col("player_id").alias("at"), F.concat(F.when(F.col("player_id") == least, "").otherwise(","), element).alias("line"))
    ends = spark.createDataFrame([(None, '{"teams": [{"id": 1, "short_name": "]"}], "elements": ['), (2**62, "], \"total\": 1}")], "at long, line string")
    lines.unionByName(ends).orderBy(F.asc_nulls_first("at")).coalesce(1).select("line").write.text(f"{root}/snapshot")
    stats = F.struct(F.col("event_points").alias("total_points"))
    live = roles.panel(spark, sf_dir).where(F.col("season") == roles.CURRENT).groupBy("gameweek").agg(
        F.to_json(F.struct(F.collect_list(F.struct("id", stats.alias("stats"))).alias("elements"))).alias("doc"))
    live.write.partitionBy("gameweek").text(f"{root}/live")


def tree_root(spark: SparkSession, sf_dir: str) -> str:
    """The tree of a session and folder; written once and used by all queries here."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if ROOTS.get(key) in SCRATCH:
        return ROOTS[key]
    root = scratch_path(spark, "layout")

    def period(name: str) -> Column:
        return F.concat("season", F.lit("/By Gameweek/GW"), "gameweek", F.lit(f"/{name}"))

    stats = "player_gameweek_stats.csv"
    panel, matches = roles.panel(spark, sf_dir), roles.matches(spark, sf_dir)
    write_files(panel, period(stats), root)
    write_files(panel.limit(1), F.lit(f"{roles.CURRENT}/By Gameweek/GWx/{stats}"), root)
    write_files(matches.where(F.col("season") == roles.CURRENT), period("fixtures.csv"), root)
    unrated = matches.where(F.col("season") != roles.CURRENT).drop("home_team_elo", "away_team_elo")
    write_files(unrated, period("fixtures.csv"), root)
    write_files(roles.members(spark, sf_dir), F.concat("season", F.lit("/players.csv")), root)
    teams = roles.teams(spark, sf_dir).withColumnsRenamed({"team_code": "code", "team_short": "short_name"})
    uncoded = teams.limit(1).withColumn("code", F.lit(None).cast("long"))
    write_files(teams.unionByName(uncoded), F.concat("season", F.lit("/teams.csv")), root)
    forecasts = roles.naive_forecasts(spark, sf_dir)
    write_files(forecasts, F.concat(F.lit("predictions/gw"), "gameweek", F.lit("_predictions.csv")), root)
    write_corrections(spark, sf_dir, root)
    write_documents(spark, sf_dir, root)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    empty = jvm.org.apache.hadoop.fs.Path(f"{root}/{roles.CURRENT}/By Gameweek/GW99/{stats}")
    empty.getFileSystem(conf).create(empty).close()
    ROOTS[key] = root
    return root


@query("layout_panel", ROLES_SQL + """SELECT season, gameweek, id, event_points, minutes, expected_goals, expected_assists,
  goals_conceded, clean_sheets, total_shots FROM panel""")
def layout_panel(spark, sf_dir):
    columns = ("event_points", "minutes", "expected_goals", "expected_assists", "goals_conceded", "clean_sheets", "total_shots")
    return tree.load_panel(spark, tree_root(spark, sf_dir)).select("season", "gameweek", "id", *columns)


@query("layout_fixtures", ROLES_SQL + """SELECT season, gameweek, team_code, opp_code, is_home,
  CASE WHEN season = '2024-B' THEN team_elo END AS team_elo, CASE WHEN season = '2024-B' THEN opp_elo END AS opp_elo FROM fixtures""")
def layout_fixtures(spark, sf_dir):
    """Files without ratings keep their matches."""
    return tree.load_fixtures(spark, tree_root(spark, sf_dir))


@query("layout_members", ROLES_SQL + "SELECT * FROM members")
def layout_members(spark, sf_dir):
    return tree.scan_members(spark, tree_root(spark, sf_dir))


@query("layout_teams", ROLES_SQL + "SELECT * FROM teams")
def layout_teams(spark, sf_dir):
    return tree.scan_teams(spark, tree_root(spark, sf_dir))


@query("layout_one_season", ROLES_SQL + "SELECT * FROM teams WHERE season = '2024-B'")
def layout_one_season(spark, sf_dir):
    return tree.one_season(tree.scan_teams(spark, tree_root(spark, sf_dir)), roles.CURRENT)


@query("layout_one_table", ROLES_SQL + "SELECT player_id, team_code, position, web_name FROM members WHERE season = '2024-B'")
def layout_one_table(spark, sf_dir):
    spec = {"player_id": "long", "team_code": "long", "position": "string", "web_name": "string"}
    return tree.read_table(spark, f"{tree_root(spark, sf_dir)}/{roles.CURRENT}/players.csv", spec).select(*spec)


@query("layout_report", ROLES_SQL + """SELECT 'read' AS outcome, count(DISTINCT (season, gameweek)) AS files FROM panel
  UNION ALL SELECT 'empty', 1 UNION ALL SELECT 'other path', 1""")
def layout_report(spark, sf_dir):
    """How many panel files were read, and why the others were not."""
    pattern = f"{tree_root(spark, sf_dir)}/*/By Gameweek/GW*/player_gameweek_stats.csv"
    return tree.scan_report(spark, pattern).groupBy("outcome").agg(F.count(F.lit(1)).alias("files"))


@query("layout_unrated_files", ROLES_SQL + """SELECT season, count(DISTINCT gameweek) AS files FROM matches WHERE season = '2024-A' GROUP BY 1""")
def layout_unrated_files(spark, sf_dir):
    """Fixture files that lack the ratings, by season."""
    report = tree.scan_report(spark, f"{tree_root(spark, sf_dir)}/*/By Gameweek/GW*/fixtures.csv", required=list(PAIR_TYPES))
    season = F.regexp_extract("file", tree.PERIOD_PATH, 1).alias("season")
    return report.where(F.col("outcome").startswith("lacks")).groupBy(season).agg(F.count(F.lit(1)).alias("files"))


@query("layout_training_frame", ROLES_SQL + """SELECT season, gameweek, count(*) AS "rows", count(team_elo) AS rated, round(sum(event_points), 4) AS points
  FROM (SELECT * REPLACE (CASE WHEN season = '2024-B' THEN team_elo END AS team_elo) FROM model) GROUP BY 1, 2""")
def layout_training_frame(spark, sf_dir):
    """The frame that models are trained on, built from files alone."""
    root = tree_root(spark, sf_dir)
    teams = tree.scan_teams(spark, root)
    rows = engineered(model_table(tree.load_panel(spark, root), tree.scan_members(spark, root), tree.load_fixtures(spark, root), teams))
    counted = rows.groupBy("season", "gameweek").agg(
        F.count(F.lit(1)).alias("rows"), F.count("team_elo").alias("rated"), F.sum("event_points").alias("points"))
    return rounded(counted, "points", digits=4)


@query("layout_training_counts", ROLES_SQL + """SELECT unnest(['rows', 'without_team', 'fixture_rows', 'without_fixture', 'without_strength',
    'lacks_pts_prev_gw', 'lacks_opp_def_strength', 'lacks_event_points', 'kept']) AS step,
  unnest([(SELECT count(*) FROM panel), (SELECT count(*) FROM panel p WHERE NOT EXISTS (FROM members m WHERE m.season = p.season AND m.player_id = p.id)),
    count(*), count(*) FILTER (WHERE opp_code IS NULL), count(*) FILTER (WHERE opp_code IS NOT NULL AND opp_def_strength IS NULL),
    count(*) FILTER (WHERE pts_prev_gw IS NULL), count(*) FILTER (WHERE opp_def_strength IS NULL), count(*) FILTER (WHERE event_points IS NULL),
    (SELECT count(*) FROM model)]) AS "rows" FROM context""")
def layout_training_counts(spark, sf_dir):
    """What the joins to that frame leave without a partner and its requirements drop, counted while it is written."""
    root, counts = tree_root(spark, sf_dir), Counts()
    teams = tree.scan_teams(spark, root)
    rows = model_table(tree.load_panel(spark, root), tree.scan_members(spark, root), tree.load_fixtures(spark, root), teams, counts=counts)
    write_periods(rows, scratch_path(spark, "frame"))
    return counts.table(spark)


@query("layout_forecast_errors", ROLES_SQL + "SELECT season, gameweek, id, predicted_points, event_points, error, abs_error FROM reconciled")
def layout_forecast_errors(spark, sf_dir):
    """All forecast files in one plan, reconciled with what happened."""
    spec = {"gameweek": "int", "player_name": "string", "team_short": "string", "position": "string", "predicted_points": "double"}
    pattern = f"{tree_root(spark, sf_dir)}/predictions/*.csv"
    forecasts = tree.scan_named_periods(spark, pattern, "_predictions.csv", spec).where("gameweek = file_period")
    rows = reconcile(forecasts, roles.named_actuals(spark, sf_dir), roles.names(spark, sf_dir).where(F.col("season") == roles.CURRENT))
    return rounded(rows, "error", "abs_error").select("season", "gameweek", "id", "predicted_points", "event_points", "error", "abs_error")


@query("layout_errors_written", ROLES_SQL + "SELECT season, gameweek, id, predicted_points, event_points, error, abs_error FROM reconciled")
def layout_errors_written(spark, sf_dir):
    """The errors of every forecast file, written to a folder a period and read from there."""
    path = scratch_path(spark, "errors")
    write_periods(layout_forecast_errors(spark, sf_dir), path)
    schema = "id long, predicted_points double, event_points double, error double, abs_error double, season string, gameweek int"
    return spark.read.schema(schema).parquet(path)


FILES_PATCH_SQL = PATCH_SQL.replace(
    "'gw_' || event_type || '-points.csv'", "'gw' || CASE WHEN event_type = 'view' THEN day(ts) % 20 + 1 ELSE day(ts) END || '-points.csv'")


@query("layout_patch", FILES_PATCH_SQL + "SELECT * FROM patched")
def layout_patch(spark, sf_dir):
    """Correction files by name in one plan, applied to a versioned panel; files of other names are left alone."""
    spec = {"player_id": "long", "gameweek": "int", "event_points": "double"}
    files = f"{tree_root(spark, sf_dir)}/actual-points/*.csv"
    fixes = tree.scan_named_periods(spark, files, "-points.csv", spec, whole=True, skip_others=True).withColumnRenamed("player_id", "id")
    empty = versions.current(spark, scratch_path(spark, "patched"))
    first = versions.commit(empty, {"panel": versions.Change(zeroed_panel(spark, sf_dir))})
    return patch_version(first, fixes).table("panel")


@query("layout_snapshot", ROLES_SQL + """SELECT player_id, web_name || ' }{"' AS player_short_name, team_code AS team_id FROM members WHERE season = '2024-B'""")
def layout_snapshot(spark, sf_dir):
    """The members listed in one JSON document, read by byte ranges."""
    rows = read_elements(spark, f"{tree_root(spark, sf_dir)}/snapshot", "elements", "id bigint, web_name string, team bigint")
    return rows.withColumnsRenamed({"id": "player_id", "web_name": "player_short_name", "team": "team_id"})


@query("layout_live", ROLES_SQL + "SELECT gameweek, id AS player_id, event_points FROM panel WHERE season = '2024-B'")
def layout_live(spark, sf_dir):
    """The points listed in one JSON document a period."""
    documents = spark.read.schema(f"{LIVE_SCHEMA}, gameweek int").option("multiLine", True).json(f"{tree_root(spark, sf_dir)}/live")
    return live_points(documents, "gameweek")
