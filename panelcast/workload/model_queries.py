"""Queries that fit models. Scoring uses the library's default settings.

The grid compares nine fits at fewer trees and rounds than the defaults: 500 boosting rounds are 500
times eight short Spark jobs one after another, and take over five minutes on a small machine for any
number of rows. All rows are used in every fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.plans import models, moments
from panelcast.plans.model_table import FEATURE_SETS, TARGET, engineered, model_table, time_split
from panelcast.sources.tree import one_season
from panelcast.workload import roles
from panelcast.workload.feature_queries import NEXT_SQL
from panelcast.workload.registry import query
from panelcast.workload.roles import ROLES_SQL, rounded

def current_table(spark, sf_dir):
    """The engineered model table of the current season, kept because many fits read it."""
    table = model_table(roles.panel(spark, sf_dir), *roles.dimensions(spark, sf_dir))
    return engineered(one_season(table, roles.CURRENT)).persist()


def names(spark, sf_dir):
    return one_season(roles.names(spark, sf_dir), roles.CURRENT)


RIDGE_FEATURES = ("pts_avg_last3", "mins_avg_last3")
RIDGE_SQL = ROLES_SQL + """, two AS (
  SELECT *, pts_avg_last3 AS a, mins_avg_last3 AS b, event_points AS y FROM model
  WHERE season = '2024-B' AND pts_avg_last3 IS NOT NULL AND mins_avg_last3 IS NOT NULL),
moments AS (
  SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, count(*) * covar_pop(a, a) + 1 AS saa, count(*) * covar_pop(b, b) + 1 AS sbb,
    count(*) * covar_pop(a, b) AS sab, count(*) * covar_pop(a, y) AS say, count(*) * covar_pop(b, y) AS sby FROM two WHERE gameweek <= 25),
solved AS (
  SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ka, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS kb FROM moments),
scored AS (SELECT two.*, my + ka * (a - ma) + kb * (b - mb) AS predicted FROM two, solved)
"""


@query("ridge_fit", RIDGE_SQL + """SELECT n AS "rows", round(ka, 5) AS points, round(kb, 5) AS minutes,
  round(my - ka * ma - kb * mb, 5) AS intercept FROM solved""")
def ridge_fit(spark, sf_dir):
    """Ridge on two features; the SQL solves its two equations."""
    rows = models.aligned(current_table(spark, sf_dir).where(F.col("gameweek") <= roles.CUTOFF), RIDGE_FEATURES)
    train = VectorAssembler(inputCols=list(RIDGE_FEATURES), outputCol="features").transform(rows)
    fitted = models.ridge(train, TARGET, models.Settings()).fit(train)
    facts = [F.round(F.lit(float(v)), 5).alias(n) for n, v in zip(("points", "minutes"), fitted.coefficients)]
    return train.agg(F.count(F.lit(1)).alias("rows")).select("rows", *facts, F.round(F.lit(fitted.intercept), 5).alias("intercept"))


def ridge_grid(spark, sf_dir):
    table = current_table(spark, sf_dir)
    return table, models.model_grid(table, roles.CUTOFF, {"two": RIDGE_FEATURES}, models=["Ridge"])


@query("ridge_mae", RIDGE_SQL + """SELECT CAST(0 AS INTEGER) AS ordinal, 'two' AS feature_set, 'Ridge' AS model, 2 AS n_features_used,
  round(avg(abs(predicted - y)) FILTER (WHERE gameweek <= 25), 5) AS train_mae,
  round(avg(abs(predicted - y)) FILTER (WHERE gameweek > 25), 5) AS test_mae FROM scored""")
def ridge_mae(spark, sf_dir):
    return rounded(models.grid_table(spark, ridge_grid(spark, sf_dir)[1]), "train_mae", "test_mae", digits=5)


@query("ridge_residuals", RIDGE_SQL + """SELECT s.season, gameweek, id, player_name, team_short, position,
  round(predicted, 5) AS predicted_points, y AS actual_points, round(predicted - y, 5) AS error, round(abs(predicted - y), 5) AS abs_error
  FROM scored s LEFT JOIN names n ON n.season = s.season AND n.player_id = s.id WHERE gameweek = 30""")
def ridge_residuals(spark, sf_dir):
    table, results = ridge_grid(spark, sf_dir)
    rows = models.residuals(table, models.best_of(results), names(spark, sf_dir), roles.CUTOFF, roles.EVAL_PERIOD)
    return rounded(rows, "predicted_points", "error", "abs_error", digits=5)


ORIGIN_SQL = RIDGE_SQL + """, sums AS (
  SELECT gameweek, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(y) AS y, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab,
    sum(a * y) AS ay, sum(b * y) AS by_ FROM two GROUP BY 1),
running AS (
  SELECT gameweek AS cutoff, lead(gameweek) OVER w AS next_period, sum(n) OVER w AS n, sum(a) OVER w / sum(n) OVER w AS ma,
    sum(b) OVER w / sum(n) OVER w AS mb, sum(y) OVER w / sum(n) OVER w AS my,
    sum(aa) OVER w - (sum(a) OVER w) ** 2 / sum(n) OVER w + 1 AS saa, sum(bb) OVER w - (sum(b) OVER w) ** 2 / sum(n) OVER w + 1 AS sbb,
    sum(ab) OVER w - sum(a) OVER w * sum(b) OVER w / sum(n) OVER w AS sab, sum(ay) OVER w - sum(a) OVER w * sum(y) OVER w / sum(n) OVER w AS say,
    sum(by_) OVER w - sum(b) OVER w * sum(y) OVER w / sum(n) OVER w AS sby FROM sums WINDOW w AS (ORDER BY gameweek)),
slopes AS (
  SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ca, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS cb
  FROM running WHERE next_period IS NOT NULL),
origins AS (SELECT *, my - ca * ma - cb * mb AS c0 FROM slopes),
judged AS (SELECT cutoff, next_period, gameweek, y - c0 - ca * a - cb * b AS residual FROM origins, two)
"""


@query("ridge_origins", ORIGIN_SQL + """SELECT 'two' AS feature_set, o.cutoff, CAST(any_value(n) AS BIGINT) AS "rows", round(any_value(ca), 5) AS points,
  round(any_value(cb), 5) AS minutes, round(any_value(c0), 5) AS intercept, o.next_period,
  round(sqrt(avg(residual ** 2) FILTER (WHERE gameweek <= o.cutoff)), 5) AS train_rmse,
  count(*) FILTER (WHERE gameweek = o.next_period) AS next_rows,
  round(sqrt(avg(residual ** 2) FILTER (WHERE gameweek = o.next_period)), 5) AS next_rmse,
  count(*) FILTER (WHERE gameweek > o.cutoff) AS test_rows,
  round(sqrt(avg(residual ** 2) FILTER (WHERE gameweek > o.cutoff)), 5) AS test_rmse
  FROM origins o JOIN judged j ON j.cutoff = o.cutoff GROUP BY o.cutoff, o.next_period""")
def ridge_origins(spark, sf_dir):
    """A ridge fit at every cutoff of the season with its errors, from one aggregate."""
    rows = moments.rolling_origin(current_table(spark, sf_dir), {"two": RIDGE_FEATURES})
    named = rows.withColumns({n: F.col("coefficients")[i] for i, n in enumerate(("points", "minutes"))}).drop("coefficients")
    return rounded(named, "points", "minutes", "intercept", "train_rmse", "next_rmse", "test_rmse", digits=5)


@query("ridge_origin_errors", ORIGIN_SQL + """SELECT 'two' AS feature_set, cutoff, count(*) AS "rows", round(avg(abs(residual)), 5) AS mae
  FROM judged WHERE gameweek = next_period GROUP BY cutoff""")
def ridge_origin_errors(spark, sf_dir):
    """The mean absolute error of each of these fits on the period that follows."""
    table, sets = current_table(spark, sf_dir), {"two": RIDGE_FEATURES}
    return rounded(moments.origin_errors(table, moments.rolling_origin(table, sets), sets), "mae", digits=5)


@query("ridge_origin_sets", ROLES_SQL + """, wide AS (
  SELECT *, team_elo - opp_elo AS elo_diff, form * is_home AS form_x_home FROM model WHERE season = '2024-B'),
complete AS (
  SELECT gameweek, elo_diff IS NOT NULL AND form_x_home IS NOT NULL AS interact FROM wide
  WHERE pts_avg_last3 IS NOT NULL AND mins_avg_last3 IS NOT NULL AND played60_rate_last3 IS NOT NULL AND now_cost IS NOT NULL
    AND selected_by_percent IS NOT NULL AND form IS NOT NULL AND team_elo IS NOT NULL AND opp_elo IS NOT NULL),
rows AS (
  SELECT feature_set, gameweek, count(*) AS n FROM complete, (VALUES ('baseline', false), ('extended_basic', false), ('extended_interact', true)) s(feature_set, needs)
  WHERE interact OR NOT needs GROUP BY 1, 2)
SELECT feature_set, gameweek AS cutoff, CAST(sum(n) OVER w AS BIGINT) AS "rows", lead(n) OVER w AS next_rows FROM rows
  WINDOW w AS (PARTITION BY feature_set ORDER BY gameweek) QUALIFY lead(n) OVER w IS NOT NULL""")
def ridge_origin_sets(spark, sf_dir):
    """How many rows each feature set's fit has at each cutoff, and the period after it; one job for all fits."""
    return moments.rolling_origin(current_table(spark, sf_dir)).select("feature_set", "cutoff", "rows", "next_rows")


GRID_SETTINGS = models.Settings(forest_trees=30, forest_depth=10, boost_rounds=20)

# Nine fits serve three queries, one forest four: each is fitted once a session and folder.
FITS: dict[tuple, object] = {}


def fitted_once(spark, sf_dir, name, fit):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in FITS:
        FITS[key] = fit()
    return FITS[key]


def grid(spark, sf_dir):
    table = current_table(spark, sf_dir)
    return table, fitted_once(spark, sf_dir, "grid", lambda: models.model_grid(table, roles.CUTOFF, settings=GRID_SETTINGS))


@query("model_grid")
def model_grid(spark, sf_dir):
    return models.grid_table(spark, grid(spark, sf_dir)[1])


@query("best_model")
def best_model(spark, sf_dir):
    return models.best_row(models.grid_table(spark, grid(spark, sf_dir)[1]))


@query("model_residuals")
def model_residuals(spark, sf_dir):
    table, results = grid(spark, sf_dir)
    return models.residuals(table, models.best_of(results), names(spark, sf_dir), roles.CUTOFF, roles.EVAL_PERIOD)


def forecast(spark, sf_dir):
    return fitted_once(spark, sf_dir, "forecast", lambda: models.forecast_next_period(
        roles.panel(spark, sf_dir), *roles.dimensions(spark, sf_dir), names(spark, sf_dir)
    ))


@query("forest_score")
def forest_score(spark, sf_dir):
    return forecast(spark, sf_dir).export()


@query("forest_score_rows", ROLES_SQL + NEXT_SQL + """SELECT gameweek, player_name, n.team_short, n.position
  FROM next_rows r LEFT JOIN names n ON n.season = r.season AND n.player_id = r.id""")
def forest_score_rows(spark, sf_dir):
    """Who gets a forecast: one row per entity and fixture, without the values of the trees."""
    return forecast(spark, sf_dir).export().drop("predicted_points")


@query("forest_top")
def forest_top(spark, sf_dir):
    return forecast(spark, sf_dir).top()


@query("forest_top_by_position")
def forest_top_by_position(spark, sf_dir):
    return forecast(spark, sf_dir).top_by_position(["MACHINERY", "BUILDING", "HOUSEHOLD", "AUTOMOBILE"])


@query("feature_set_rows", ROLES_SQL + """, wide AS (
  SELECT *, team_elo - opp_elo AS elo_diff, form * is_home AS form_x_home FROM model WHERE season = '2024-B'),
aligned AS (
  SELECT *, pts_avg_last3 IS NOT NULL AND mins_avg_last3 IS NOT NULL AND played60_rate_last3 IS NOT NULL AND now_cost IS NOT NULL
    AND selected_by_percent IS NOT NULL AND form IS NOT NULL AND team_elo IS NOT NULL AND opp_elo IS NOT NULL AS complete FROM wide)
SELECT feature_set, n AS n_features_used, count(*) FILTER (WHERE gameweek <= 25) AS train, count(*) FILTER (WHERE gameweek > 25) AS test
FROM aligned, (VALUES ('baseline', 11, false), ('extended_basic', 13, false), ('extended_interact', 15, true)) s(feature_set, n, interact)
WHERE complete AND (NOT interact OR (elo_diff IS NOT NULL AND form_x_home IS NOT NULL)) GROUP BY 1, 2""")
def feature_set_rows(spark, sf_dir):
    """Rows on each side of the split that have every feature of the set."""
    table = current_table(spark, sf_dir)
    counts = []
    for name, features in FEATURE_SETS.items():
        train, test = time_split(models.aligned(table, features), roles.CUTOFF)
        sides = train.select(F.lit(True).alias("early")).unionByName(test.select(F.lit(False).alias("early")))
        counts.append(sides.agg(F.count_if("early").alias("train"), F.count_if(~F.col("early")).alias("test")).select(
            F.lit(name).alias("feature_set"), F.lit(len(features)).alias("n_features_used"), "train", "test"))
    return reduce(DataFrame.unionByName, counts)


@query("tree_by_side", ROLES_SQL + """SELECT is_home, round(avg(event_points), 5) AS predicted_points, count(*) AS "rows"
  FROM model WHERE season = '2024-B' AND gameweek <= 25 GROUP BY 1""")
def tree_by_side(spark, sf_dir):
    """A forest of one tree on all rows and one two-valued feature predicts the mean of each side."""
    return by_side(spark, sf_dir, models.forest(1, TARGET, models.Settings()).setBootstrap(False))


@query("boosting_by_side", ROLES_SQL + """SELECT is_home, round(avg(event_points), 5) AS predicted_points, count(*) AS "rows"
  FROM model WHERE season = '2024-B' AND gameweek <= 25 GROUP BY 1""")
def boosting_by_side(spark, sf_dir):
    """Two rounds of boosting on it: the mean of each side, and a second tree that finds nothing left."""
    return by_side(spark, sf_dir, models.boosting(TARGET, models.Settings(boost_rounds=2, boost_min_leaf=1)))


def by_side(spark, sf_dir, estimator):
    rows = models.aligned(current_table(spark, sf_dir).where(F.col("gameweek") <= roles.CUTOFF), ["is_home"])
    train = VectorAssembler(inputCols=["is_home"], outputCol="features").transform(rows)
    scored = rounded(estimator.fit(train).transform(train), "predicted_points", digits=5)
    return scored.groupBy("is_home", "predicted_points").agg(F.count(F.lit(1)).alias("rows"))


@query("model_grid_keys", """SELECT * FROM (VALUES (0, 'baseline', 'Ridge', 11, true), (1, 'baseline', 'RandomForest', 11, true),
  (2, 'baseline', 'HistGBDT', 11, true), (3, 'extended_basic', 'Ridge', 13, true), (4, 'extended_basic', 'RandomForest', 13, true),
  (5, 'extended_basic', 'HistGBDT', 13, true), (6, 'extended_interact', 'Ridge', 15, true), (7, 'extended_interact', 'RandomForest', 15, true),
  (8, 'extended_interact', 'HistGBDT', 15, true)) t(ordinal, feature_set, model, n_features_used, trees_fit_better)""")
def model_grid_keys(spark, sf_dir):
    """Which fits the grid has, in order; on the training rows no model does worse than the ridge of its set."""
    rows = models.grid_table(spark, grid(spark, sf_dir)[1])
    ridge = rows.where("model = 'Ridge'").select("feature_set", F.col("train_mae").alias("ridge_mae"))
    better = (F.col("train_mae") <= F.col("ridge_mae")).alias("trees_fit_better")
    return rows.join(ridge, "feature_set").select("ordinal", "feature_set", "model", "n_features_used", better)


@query("forest_score_bounds", ROLES_SQL + NEXT_SQL + """SELECT count(*) AS "rows", true AS inside
  FROM next_rows r LEFT JOIN names n ON n.season = r.season AND n.player_id = r.id""")
def forest_score_bounds(spark, sf_dir):
    """Means of leaves lie between the least and the greatest target of the season."""
    target = current_table(spark, sf_dir).agg(F.min(TARGET).alias("low"), F.max(TARGET).alias("high"))
    scored = forecast(spark, sf_dir).export().crossJoin(F.broadcast(target))  # one row
    inside = F.col("predicted_points").between(F.col("low") - 1e-9, F.col("high") + 1e-9)
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(inside).alias("inside"))
