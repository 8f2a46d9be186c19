"""Joins whose kind is decided by bytes while the query runs, and counts taken on the way."""

import random
import re

from pyspark.sql import functions as F

from panelcast.operators.counted import Counts
from panelcast.operators.enrich import attach_fixtures, attach_names, attach_opponent_strength, attach_team, entity_names
from panelcast.operators.report import pending
from panelcast.plans.model_table import model_table
from panelcast.workload import roles

SF_DIR = "/root/testdata/sf0.001"


def jobs(spark, group, build):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "")
    try:
        return build(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_runs_before_an_action(spark):
    panel, dimensions = roles.panel(spark, SF_DIR), roles.dimensions(spark, SF_DIR)
    table, started = jobs(spark, "model-table", lambda: model_table(panel, *dimensions))
    assert not started and table.columns
    _, started = jobs(spark, "names", lambda: entity_names(dimensions[0], dimensions[2]))
    assert not started
    _, started = jobs(spark, "pending", lambda: pending(panel, panel.where("gameweek < 3")))
    assert not started


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_bytes_decide_the_join_and_not_rows(spark):
    """200 wide rows are more than the bound of bytes, 200 narrow ones are not; their sizes show only at run time."""
    panel = spark.range(20_000).select(
        F.lit("s").alias("season"), (F.col("id") % 5).cast("int").alias("gameweek"), (F.col("id") % 200).alias("team_code"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    try:
        for width, broadcast in ((1, True), (40_000, False)):
            rows = spark.range(4_000_000).where("id % 20000 = 7")  # the optimizer takes it for large
            fixtures = rows.select(
                F.lit("s").alias("season"), (F.col("id") % 5).cast("int").alias("gameweek"), (F.col("id") / 20_000).cast("long").alias("team_code"),
                F.col("id").alias("opp_code"), F.repeat(F.col("id").cast("string"), width).alias("note"))
            joined = attach_fixtures(panel, fixtures).groupBy().agg(F.count("opp_code"), F.max(F.length("note")))
            assert ("BroadcastHashJoin" in final_plan(joined)) == broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_entity_maps_are_not_broadcast(spark):
    """Tables that grow with the entities never pass through the driver, however few bytes their files have."""
    panel, members = roles.panel(spark, SF_DIR), roles.members(spark, SF_DIR)
    for rows in (attach_team(panel, members), attach_names(panel, members.drop("team_code")), roles.naive_forecasts(spark, SF_DIR).drop("team_short"),
                 roles.named_actuals(spark, SF_DIR).drop("team_short")):
        assert re.search(r"SortMergeJoin \[season#\d+, id#\d+L\]", plan := final_plan(rows))
        assert not re.search(r"BroadcastHashJoin \[season#\d+, id#", plan)
    assert attach_team(panel, members).count() == panel.count()


def test_columns_that_clash_get_a_suffix(spark):
    df = spark.createDataFrame([("s", 1, 5, "mine", 1)], "season string, gameweek int, team_code long, note string, is_home int")
    fixtures = spark.createDataFrame([("s", 1, 5, 7, "theirs")], "season string, gameweek int, team_code long, opp_code long, note string")
    joined = attach_fixtures(df, fixtures)
    assert joined.columns == ["season", "gameweek", "team_code", "note", "is_home", "opp_code", "note_fixture"]
    assert joined.first().note == "mine" and joined.first().note_fixture == "theirs"
    strengths = spark.createDataFrame([("s", 7, 1.0, 2.0)], "season string, team_code long, strength_defence_home double, strength_defence_away double")
    assert attach_opponent_strength(joined, strengths).first().opp_def_strength == 2.0


def test_counts_come_with_the_one_action(spark, tmp_path):
    random.seed(2)
    panel = spark.createDataFrame(
        [("s", i, g, None if i == 3 else 1.0, 90.0) for i in range(10) for g in range(1, 6)],
        "season string, id long, gameweek int, event_points double, minutes double")
    members = spark.createDataFrame([("s", i, i % 4, "F", f"n{i}") for i in range(9)],
                                    "season string, player_id long, team_code long, position string, web_name string")
    teams = spark.createDataFrame([("s", t, f"T{t}", 1.0, 2.0) for t in range(3)],
                                  "season string, team_code long, team_short string, strength_defence_home double, strength_defence_away double")
    fixtures = [("s", g, t, t ^ 1, 1 - t % 2, 1.0, 1.0) for g in range(1, 5) for t in range(4)]
    fixtures = spark.createDataFrame(fixtures, "season string, gameweek int, team_code long, opp_code long, is_home int, team_elo double, opp_elo double")
    counts = Counts()
    table = model_table(panel, members, fixtures, teams, counts=counts)
    table.write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).count()
    numbers, started = jobs(spark, "numbers", counts.numbers)
    assert not started and numbers == {
        "rows": 50, "without_team": 5, "fixture_rows": 50, "without_fixture": 14, "without_strength": 8,
        "lacks_pts_prev_gw": 14, "lacks_opp_def_strength": 22, "lacks_event_points": 5, "kept": kept,
    }
    assert {r.step: r.rows for r in counts.table(spark).collect()} == numbers
