"""Orders, unique keys, plans without jobs, and what is left behind."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelcast.operators.conform import RepeatedKeys, require_unique
from panelcast.session import SCRATCH, release
from panelcast.workload import report_queries, roles

SF_DIR = "/root/testdata/sf0.001"


def last(value):
    return (value is None, value)


@pytest.mark.parametrize(("name", "key"), [
    ("naive_residuals", lambda r: (last(r.abs_error and -r.abs_error), r.id, r.opp_code)),
    ("reconcile_fallback", lambda r: (last(r.team_short), last(r.abs_error and -r.abs_error), r.gameweek, r.id)),
    ("top_orders_by_priority", lambda r: (r.o_orderpriority, r["rank"])),
    ("forest_top", lambda r: (-r.predicted_points, r.id, r.opp_code)),
])
def test_rows_come_in_order(spark, name, key):
    rows = entry.queries()[name](spark, SF_DIR).collect()
    assert rows and rows == sorted(rows, key=key)


def test_positions_keep_the_order_asked_for(spark):
    rows = entry.queries()["top_by_position"](spark, SF_DIR).collect()
    wanted = ["MACHINERY", "BUILDING", "HOUSEHOLD", "NO SUCH SEGMENT", "AUTOMOBILE"]
    assert rows == sorted(rows, key=lambda r: (wanted.index(r.c_mktsegment), r["rank"]))


def test_keys_that_repeat_stop_with_samples(spark):
    panel = roles.panel(spark, SF_DIR)
    assert require_unique(panel) is panel
    with pytest.raises(RepeatedKeys, match="2024-A"):
        require_unique(panel.unionByName(panel.where(F.col("season") == "2024-A")))


def test_reconcile_starts_no_job_before_an_action(spark):
    tracker = spark.sparkContext.statusTracker()
    forecasts, actuals = roles.naive_forecasts(spark, SF_DIR), roles.named_actuals(spark, SF_DIR)
    names = roles.names(spark, SF_DIR)
    spark.sparkContext.setJobGroup("lazy", "")
    plan = report_queries.reconcile(forecasts, actuals, names)
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.columns


@pytest.mark.parametrize("name", ["scan_drifting_headers", "rolling_orders_split", "rolling_global_compat", "ridge_mae", "patch_versioned"])
def test_nothing_is_left_after_release(spark, name):
    entry.queries()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    folders = [p.removeprefix("file://") for p in SCRATCH]
    release(spark)
    assert not SCRATCH and not any(map(os.path.exists, folders))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
