import pytest
from pyspark.sql import functions as F
from test_rolling import SCHEMA, random_panel

from panelcast.operators.carry import advance, rolled_on, state_columns, tail
from panelcast.operators.rolling import FORM_ALL, FORM_LAST3, rolling_features, with_form_inputs
from panelcast.sources import versions

KEYS, ORDER = ("season", "id"), ("gameweek",)


def inputs(spark, seed=1):
    rows = with_form_inputs(spark.createDataFrame(random_panel(seed), SCHEMA))
    return rows.select(*state_columns(FORM_ALL, KEYS, ORDER))


def values(df, specs=FORM_ALL):
    return {
        (r.season, r.id, r.gameweek): tuple(None if r[s.name] is None else round(r[s.name], 9) for s in specs) for r in df.collect()
    }


@pytest.mark.parametrize("steps", [[30], [10, 11, 12, 25, 30], [1, 2, 3, 4, 5, 30]])
def test_steps_equal_one_window_over_all(spark, tmp_path, steps):
    panel = inputs(spark, len(steps))
    at = versions.current(spark, str(tmp_path))
    done = 0
    for upto in steps:
        at = advance(at, panel.where((F.col("gameweek") > done) & (F.col("gameweek") <= upto)), FORM_ALL)
        done = upto
    assert values(at.table("features")) == values(rolling_features(panel, FORM_ALL))
    kept = at.table("state").groupBy(*KEYS).count().collect()
    assert max(r["count"] for r in kept) == 5 and len(kept) == 24
    assert at.number == len(steps)


def test_a_step_reads_the_state_and_its_period_and_nothing_older(spark, tmp_path):
    empty = versions.current(spark, str(tmp_path))
    landed = versions.commit(empty, {"panel": versions.Change(inputs(spark))})
    panel = landed.table("panel")
    at = advance(landed, panel.where("gameweek <= 20"), FORM_ALL)
    step = rolled_on(at.table("state"), panel.where("gameweek = 21"), FORM_ALL)
    read = step._jdf.queryExecution().executedPlan().toString()
    assert read.count("FileScan parquet") == 2 and "gameweek#" in read and "= 21)" in read
    # columns of partitions tell which files tasks open
    opened = at.table("panel").where("gameweek = 21").select(F.input_file_name().alias("f")).distinct().collect()
    assert opened and all("gameweek=21/" in r.f for r in opened)


def test_features_and_state_advance_together(spark, tmp_path):
    panel = inputs(spark)
    first = advance(versions.current(spark, str(tmp_path)), panel.where("gameweek <= 9"), FORM_LAST3)
    second = advance(first, panel.where("gameweek = 10"), FORM_LAST3)
    with pytest.raises(versions.Conflict):  # the state has moved on
        advance(first, panel.where("gameweek = 11"), FORM_LAST3)
    with pytest.raises(Exception, match="not later than the state"):
        advance(second, panel.where("gameweek = 10"), FORM_LAST3)
    now = versions.current(spark, str(tmp_path))
    assert now.number == 2 and {p["gameweek"] for p in now.places("features")} == set(range(1, 11))
    older = {e: f for e, f in now.folders("features").items() if '"gameweek": 10' not in e}
    assert older == first.folders("features")


def test_new_entities_seasons_and_empty_steps(spark, tmp_path):
    schema = "season string, id long, gameweek int, event_points double, minutes double, played60 double"
    rows = [("a", 1, 1, 2.0, 90.0, 1.0), ("a", 2, 1, None, 10.0, 0.0), ("a", 1, 2, 4.0, 90.0, 1.0), ("b", 1, 1, 7.0, 90.0, 1.0)]
    frame = spark.createDataFrame(rows, schema)
    at = advance(versions.current(spark, str(tmp_path)), frame.limit(0), FORM_LAST3)
    assert at.table("features").count() == 0 == at.table("state").count()
    at = advance(at, frame.where("season = 'a' AND gameweek = 1"), FORM_LAST3)
    at = advance(at, frame.where("gameweek = 2 OR season = 'b'"), FORM_LAST3)
    assert values(at.table("features"), FORM_LAST3) == values(rolling_features(frame, FORM_LAST3), FORM_LAST3)
    assert tail(frame, FORM_LAST3).count() == 4
