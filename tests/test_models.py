import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from panelcast.plans import models

SMALL = models.Settings(
    forest_trees=3, scoring_trees=20, forest_depth=5, boost_rounds=3, max_bins=16
)
SETS = {"one": ("a",), "two": ("a", "b")}


def table(spark, periods=range(1, 11), season="s"):
    random.seed(1)
    rows = []
    for gw in periods:
        for i in range(30):
            a, b = random.random() * 10, random.random()
            b = None if random.random() < 0.1 else b
            rows.append((season, gw, i, a, b, 3 * a + (b or 0) + random.random() if random.random() > 0.05 else None))
    return spark.createDataFrame(rows, "season string, gameweek int, id long, a double, b double, event_points double")


def test_ridge_is_the_closed_form(spark):
    rows = models.aligned(table(spark), ["a", "b"])
    train = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    for alpha in (1.0, 50.0):
        model = models.ridge(train, "event_points", models.Settings(alpha=alpha)).fit(train)
        data = np.array([tuple(r) for r in rows.select("a", "b", "event_points").collect()])
        x, y = data[:, :2] - data[:, :2].mean(axis=0), data[:, 2] - data[:, 2].mean()
        wanted = np.linalg.solve(x.T @ x + alpha * np.eye(2), x.T @ y)
        np.testing.assert_allclose(model.coefficients.toArray(), wanted, rtol=1e-8)


def test_grid_and_best(spark):
    df = table(spark)
    results = models.model_grid(df, 8, SETS, SMALL)
    assert [(r.feature_set, r.model) for r in results] == [
        (s, m) for s in SETS for m in ("Ridge", "RandomForest", "HistGBDT")]
    metrics = models.grid_table(spark, results)
    best = models.best_of(results)
    row = models.best_row(metrics).first()
    assert (row["feature_set"], row["model"]) == (best.feature_set, best.model) == ("two", "Ridge")
    assert best.test_mae < 0.5
    names = spark.createDataFrame([("s", i, f"n{i}", "T", "M") for i in range(30)],
                                  "season string, player_id long, player_name string, team_short string, position string")
    one = models.residuals(df, best, names, 8, 9)
    assert one.columns == list(models.RESIDUAL_COLUMNS)
    errors = [r["abs_error"] for r in one.collect()]
    assert errors == sorted(errors, reverse=True) and {r["gameweek"] for r in one.collect()} == {9}
    absent = models.residuals(df, best, names, 8, 77)
    assert {r["gameweek"] for r in absent.select("gameweek").distinct().collect()} == {9, 10}


def test_no_result_without_both_sides(spark):
    df = table(spark, range(1, 3))
    assert models.model_grid(df, 5, SETS, SMALL) == [] and models.model_grid(df, 0, SETS, SMALL) == []
    assert models.best_of([]) is None


def test_first_wins_a_tie(spark):
    metrics = spark.createDataFrame([(0, 2.0), (1, 1.0), (2, 1.0)], "ordinal int, test_mae double")
    assert models.best_row(metrics).first()["ordinal"] == 1


def test_scoring_fills_missing_features(spark):
    model = models.scoring_model(table(spark), ["a", "b"], SMALL)
    upcoming = spark.createDataFrame([(1, 5.0, None), (2, None, 0.5), (3, 9.0, 0.5)], "id int, a double, b double")
    got = {r["id"]: r["predicted_points"] for r in model.transform(upcoming).collect()}
    assert set(got) == {1, 2, 3} and 10 < got[1] < 21 and got[3] > 21


@pytest.fixture
def small_league(spark):
    random.seed(3)
    panel = [("s", i, gw, float(random.randint(0, 9)), 90.0, "4.5", "10%", "1.0") for i in range(40) for gw in range(1, 9)]
    panel = spark.createDataFrame(panel, "season string, id long, gameweek int, event_points double, minutes double, now_cost string, "
                                         "selected_by_percent string, form string")
    members = spark.createDataFrame([("s", i, i % 4, "F" if i % 2 else "D", f"n{i}") for i in range(40)],
                                    "season string, player_id long, team_code long, position string, web_name string")
    teams = spark.createDataFrame([("s", t, f"T{t}", 1.0 + t, 2.0 + t) for t in range(4)],
                                  "season string, team_code long, team_short string, strength_defence_home double, strength_defence_away double")
    fixtures = [("s", gw, t, t ^ 1, 1 - t % 2, 1500.0 + t, 1500.0 + (t ^ 1)) for gw in range(1, 10) for t in range(4 if gw < 9 else 2)]
    fixtures = spark.createDataFrame(fixtures, "season string, gameweek int, team_code long, opp_code long, is_home int, team_elo double, opp_elo double")
    names = spark.createDataFrame([("s", i, f"n{i}", f"T{i % 4}", "F" if i % 2 else "D") for i in range(40)],
                                  "season string, player_id long, player_name string, team_short string, position string")
    return panel, members, fixtures, teams, names


def test_forecast(small_league):
    panel, members, fixtures, teams, names = small_league
    forecast = models.forecast_next_period(panel, members, fixtures, teams, names, settings=SMALL)
    rows = forecast.export().collect()
    assert len(rows) == 20 and {r["gameweek"] for r in rows} == {9} and {r["team_short"] for r in rows} == {"T0", "T1"}
    points = [r["predicted_points"] for r in rows]
    assert points == sorted(points, reverse=True)
    assert forecast.top(5).count() == 5
    assert [r["position"] for r in forecast.top_by_position(["F", "X", "D"], 2).collect()] == ["F", "F", "D", "D"]


def test_forecast_needs_rows_and_fixtures(small_league):
    panel, members, fixtures, teams, names = small_league
    assert models.forecast_next_period(panel.where("gameweek = 1"), members, fixtures, teams, names, settings=SMALL) is None
    assert models.forecast_next_period(panel, members, fixtures.where("gameweek < 9"), teams, names, settings=SMALL) is None
