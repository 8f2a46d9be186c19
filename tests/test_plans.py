"""Physical plans: what is read, how often it is shuffled, and which joins appear."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelcast.operators.rank import top_by_group, top_overall
from panelcast.operators.rolling import FORM_ALL, rolling_features, with_form_inputs
from panelcast.operators.snapshot import latest_rows
from panelcast.sources.sink import write_periods
from panelcast.workload import roles

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")
FITS_MODELS = ("forest", "model_", "best_model", "ridge")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", [n for n in sorted(entry.queries()) if not n.startswith(FITS_MODELS)])
def test_no_query_pairs_all_rows(name, spark):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time Python


@needs_tables
def test_scan_reads_only_what_the_features_need(spark):
    text = plan(entry.queries()["panel_form"](spark, SF_DIR))
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["event_type", "ts", "user_id", "value"]


@needs_tables
def test_unused_features_are_not_computed(spark):
    rows = rolling_features(with_form_inputs(roles.panel(spark, SF_DIR)), FORM_ALL)
    text = plan(rows.select("season", "id", "gameweek", "pts_prev_gw"))
    assert "avg(" not in text and "lag(" in text


def test_season_filter_prunes_folders_through_the_window(spark, tmp_path):
    data = spark.range(60).select(
        F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("season"), (F.col("id") % 6).cast("int").alias("gameweek"),
        F.col("id") % 5, F.col("id").cast("double").alias("event_points"), F.lit(90.0).alias("minutes"),
    ).toDF("season", "gameweek", "id", "event_points", "minutes")
    write_periods(data, str(tmp_path / "t"))
    rolled = rolling_features(with_form_inputs(spark.read.parquet(str(tmp_path / "t"))))
    text = plan(rolled.where(F.col("season") == "s1"))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "season" in filters and "s1" in filters


def test_leaderboards_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    for limited in (top_by_group(df, "g", "v", ["id"], 2), latest_rows(df, ["g"], ["v"])):
        assert plan(limited).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(top_overall(df, "v", ["id"], 5))
