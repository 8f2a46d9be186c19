import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators.blocks import number_rows, with_halo
from panelcast.operators.rolling import FORM_ALL, FORM_LAST3, Lag, Roll, rolling_features, with_form_inputs

INPUTS = ["event_points", "minutes", "played60", "xgi", "total_shots", "clean_sheets", "goals_conceded"]
NAMES = [s.name for s in FORM_ALL]


def random_panel(seed, entities=12, periods=30, hot=None):
    random.seed(seed)
    rows = []
    for season in ("a", "b"):
        for entity in range(entities):
            length = hot if hot and entity == 3 else random.choice([1, 2, 3, periods // 2, periods])
            for gw in sorted(random.sample(range(1, max(periods, length) + 1), length)):
                maybe = lambda v: None if random.random() < 0.15 else float(v)
                rows.append((season, entity, gw, maybe(random.randint(0, 15)), maybe(random.choice([0, 59, 60, 90])),
                             maybe(random.random()), maybe(random.random()), maybe(random.randint(0, 2)),
                             maybe(random.randint(0, 1)), maybe(random.randint(0, 9))))
    random.shuffle(rows)
    return rows


SCHEMA = ("season string, id long, gameweek int, event_points double, minutes double, expected_goals double, "
          "expected_assists double, goals_conceded double, clean_sheets double, total_shots double")


def by_hand(rows, mode):
    """Plain Python: entity frames, or frames over the whole sorted table behind a lag per entity."""
    table = sorted(rows)
    values = []
    for r in table:
        minutes = r[4]
        values.append(dict(zip(INPUTS, [r[3], minutes, float(minutes is not None and minutes >= 60),
                                        (r[5] or 0.0) + (r[6] or 0.0), r[9], r[8], r[7]])))
    out = {}
    for i, r in enumerate(table):
        result = {}
        for s in FORM_ALL:
            def lagged(j, s=s):
                same = j > 0 and table[j - 1][:2] == table[j][:2]
                return values[j - 1][s.column] if same else None
            if isinstance(s, Lag):
                result[s.name] = lagged(i)
                continue
            if mode == "entity":
                frame = [values[j][s.column] for j in range(max(0, i - s.width), i) if table[j][:2] == r[:2]]
            else:
                frame = [lagged(j) for j in range(max(0, i - s.width + 1), i + 1)]
            frame = [v for v in frame if v is not None]
            total = sum(frame) if frame else None
            result[s.name] = total if s.agg == "sum" or not frame else total / len(frame)
        out[r[:3]] = result
    return out


def check(df, wanted):
    got = {(r["season"], r["id"], r["gameweek"]): r for r in df.collect()}
    assert got.keys() == wanted.keys()
    for key, values in wanted.items():
        for name, value in values.items():
            actual = got[key][name]
            same = (actual is None) == (value is None) and (value is None or math.isclose(actual, value, abs_tol=1e-9))
            assert same, (key, name, actual, value)


@pytest.mark.parametrize("seed", [1, 2])
def test_entity_mode(spark, seed):
    rows = random_panel(seed)
    panel = with_form_inputs(spark.createDataFrame(rows, SCHEMA))
    check(rolling_features(panel, FORM_ALL), by_hand(rows, "entity"))


@pytest.mark.parametrize("block_rows", [5, 16, 10_000])
def test_global_mode(spark, block_rows):
    rows = random_panel(3)
    panel = with_form_inputs(spark.createDataFrame(rows, SCHEMA)).repartition(6)
    check(rolling_features(panel, FORM_ALL, mode="global", block_rows=block_rows), by_hand(rows, "global"))


@pytest.mark.parametrize("block_rows", [5, 64])
def test_hot_entity_is_split(spark, block_rows):
    rows = random_panel(4, entities=9, hot=400)
    panel = with_form_inputs(spark.createDataFrame(rows, SCHEMA)).repartition(7)
    check(rolling_features(panel, FORM_ALL, hot_rows=25, block_rows=block_rows), by_hand(rows, "entity"))


def test_null_key_rows_stay_whole(spark):
    rows = [(None, i, float(i)) for i in range(50)] + [(1, i, float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, t int, v double")
    out = rolling_features(df, [Roll("v", "sum", 2, "s")], keys=["id"], order=["t"], hot_rows=10, block_rows=8)
    assert out.count() == 53
    assert out.where("id is null and t = 9").first()["s"] == 15.0


def test_border_between_entities(spark):
    rows = [("s", 1, 1, 10.0), ("s", 1, 2, 20.0), ("s", 1, 3, 30.0), ("s", 2, 1, 1.0), ("s", 2, 2, 2.0)]
    df = spark.createDataFrame(rows, "season string, id int, gameweek int, v double")
    spec = [Roll("v", "avg", 3, "m")]
    second = lambda out: out.where("id = 2 and gameweek = 2").first()["m"]
    assert second(rolling_features(df, spec)) == 1.0
    # the frame holds the lags 20, null (first row of entity 2) and 1
    assert second(rolling_features(df, spec, mode="global")) == 10.5


def test_no_leak_from_later_rows(spark):
    rows = random_panel(5)
    cut = 12
    changed = [r if r[2] < cut else (*r[:3], 99.0, 1.0, 9.0, 9.0, 9.0, 9.0, 9.0) for r in rows]
    features = lambda data: {
        (r["season"], r["id"], r["gameweek"]): tuple(r[n] for n in NAMES)
        for r in rolling_features(with_form_inputs(spark.createDataFrame(data, SCHEMA)), FORM_ALL)
        .where(F.col("gameweek") < cut).collect()
    }
    assert features(rows) == features(changed)


def test_absent_sources_give_null(spark):
    df = spark.createDataFrame([("s", 1, 1, 2.0, 90.0), ("s", 1, 2, 2.0, 90.0)],
                               "season string, id int, gameweek int, event_points double, minutes double")
    row = rolling_features(with_form_inputs(df), FORM_ALL).where("gameweek = 2").first()
    assert row["pts_prev_gw"] == 2.0 and row["played60_rate_last3"] == 1.0
    assert [row[n] for n in ("xgi_avg_last3", "shots_last5", "cs_rate_last3", "gc_avg_last5")] == [None] * 4


def test_numbering_and_halo(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(9)
    numbered = number_rows(df, ["k"])
    assert numbered.where("_row <> k").count() == 0
    halo = with_halo(numbered, 3, 10)
    assert halo.where("not _copy").count() == 1000 and halo.where("_copy").count() == 300
    assert halo.groupBy("_block").count().agg(F.max("count")).first()[0] == 13
    with pytest.raises(ValueError):
        with_halo(numbered, 20, 10)


def test_one_shuffle_and_one_window_for_all_features(spark):
    df = with_form_inputs(spark.createDataFrame(random_panel(6), SCHEMA))
    plan = rolling_features(df, FORM_ALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Window") == 1


def test_pandas_agrees(spark):
    pdf = pd.DataFrame(random_panel(7), columns=[c.split()[0] for c in SCHEMA.split(", ")])
    pdf = pdf.sort_values(["season", "id", "gameweek"])
    pdf["wanted"] = pdf.groupby(["season", "id"])["event_points"].transform(lambda s: s.shift(1).rolling(3, min_periods=1).mean())
    panel = with_form_inputs(spark.createDataFrame(random_panel(7), SCHEMA))
    got = rolling_features(panel, FORM_LAST3).select("season", "id", "gameweek", "pts_avg_last3").toPandas()
    both = pdf.merge(got, on=["season", "id", "gameweek"])
    assert len(both) == len(pdf)
    pd.testing.assert_series_equal(both["wanted"], both["pts_avg_last3"], check_names=False)
