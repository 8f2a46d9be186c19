"""Queries for errors, leaderboards, key reconciliation and corrections."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from panelcast.operators.patch import patch_version, patch_zero_targets, season_rows
from panelcast.operators.conform import repeated_keys
from panelcast.operators.keys import extended, known_keys
from panelcast.operators.rank import first_periods, sorted_distinct, top_by_group, top_overall
from panelcast.operators.reconcile import (
    NAME_KEYS,
    period_routes,
    prepare_actuals,
    reconcile,
    reconcile_by_id,
    reconcile_direct,
    resolve_ids,
)
from panelcast.operators.report import (
    axis_limits,
    by_team_worst_first,
    mean_absolute_error,
    pending,
    scatter_points,
    shape,
    with_errors,
    worst_first,
)
from panelcast.operators.rolling import FORM_ALL
from panelcast.operators.snapshot import sum_by_entity
from panelcast.plans.models import best_row
from panelcast.session import scratch_path
from panelcast.sources import versions
from panelcast.sources.tree import one_season
from panelcast.workload import roles
from panelcast.workload.feature_queries import WIDE_MODEL
from panelcast.workload.registry import query
from panelcast.workload.roles import ROLES_SQL, rounded, table

# --- errors of naive forecasts --------------------------------------------------------------------

def split_of(period):
    return F.when(period <= roles.CUTOFF, F.lit("train")).otherwise(F.lit("test"))


def current_model(spark, sf_dir):
    return one_season(roles.form_model(spark, sf_dir, FORM_ALL, columns=WIDE_MODEL), roles.CURRENT)


def naive(spark, sf_dir):
    """Forecast = mean of the last three targets, on the rows of the model table."""
    return current_model(spark, sf_dir).withColumn("predicted_points", F.col("pts_avg_last3"))


@query("naive_mae", ROLES_SQL + """SELECT CASE WHEN gameweek <= 25 THEN 'train' ELSE 'test' END AS split,
  round(avg(abs(pts_avg_last3 - event_points)), 6) AS mae, count(pts_avg_last3) AS "rows" FROM model WHERE season = '2024-B' GROUP BY 1""")
def naive_mae(spark, sf_dir):
    return rounded(mean_absolute_error(naive(spark, sf_dir).withColumn("split", split_of(F.col("gameweek"))), ["split"]), "mae")


@query("naive_residuals", ROLES_SQL + """SELECT m.season, gameweek, id, opp_code, player_name, team_short, position,
  round(pts_avg_last3, 6) AS predicted_points, event_points, round(pts_avg_last3 - event_points, 6) AS error,
  round(abs(pts_avg_last3 - event_points), 6) AS abs_error
  FROM model m LEFT JOIN names n ON n.season = m.season AND n.player_id = m.id WHERE m.season = '2024-B' AND gameweek = 30""")
def naive_residuals(spark, sf_dir):
    rows = naive(spark, sf_dir).where(F.col("gameweek") == roles.EVAL_PERIOD)
    named = rows.join(roles.names(spark, sf_dir).withColumnRenamed("player_id", "id"), ["season", "id"], "left")
    columns = ["season", "gameweek", "id", "opp_code", "player_name", "team_short", "position", "predicted_points", "event_points"]
    errors = rounded(with_errors(named.select(columns)), "predicted_points", "error", "abs_error")
    return worst_first(errors, ["id", "opp_code"])


@query("best_combo", ROLES_SQL + """, errors AS (
  SELECT 0 AS ordinal, 'prev' AS model, gameweek, abs(pts_prev_gw - event_points) AS e FROM model WHERE season = '2024-B'
  UNION ALL SELECT 1, 'last3', gameweek, abs(pts_avg_last3 - event_points) FROM model WHERE season = '2024-B'
  UNION ALL SELECT 2, 'last5', gameweek, abs(pts_avg_last5 - event_points) FROM model WHERE season = '2024-B')
  SELECT CAST(ordinal AS INTEGER) AS ordinal, model, round(avg(e) FILTER (WHERE gameweek <= 25), 6) AS train_mae,
    round(avg(e) FILTER (WHERE gameweek > 25), 6) AS test_mae FROM errors GROUP BY 1, 2 ORDER BY test_mae, ordinal LIMIT 1""")
def best_combo(spark, sf_dir):
    models = {"prev": "pts_prev_gw", "last3": "pts_avg_last3", "last5": "pts_avg_last5"}
    forecasts = F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("model"), F.abs(F.col(c) - F.col("event_points")).alias("e"))
        for i, (name, c) in enumerate(models.items())
    ]))
    errors = current_model(spark, sf_dir).select("gameweek", "event_points", *models.values()).select("gameweek", forecasts)
    early = F.col("gameweek") <= roles.CUTOFF
    metrics = errors.groupBy("ordinal", "model").agg(
        F.avg(F.when(early, F.col("e"))).alias("train_mae"), F.avg(F.when(~early, F.col("e"))).alias("test_mae")
    )
    return rounded(best_row(metrics), "train_mae", "test_mae")


@query("summed_forecasts", ROLES_SQL + """SELECT season, gameweek, id, round(sum(pts_avg_last3), 6) AS predicted_points,
  count(*) AS fixtures FROM model WHERE season = '2024-B' GROUP BY 1, 2, 3""")
def summed_forecasts(spark, sf_dir):
    return rounded(sum_by_entity(naive(spark, sf_dir)), "predicted_points")


# --- leaderboards ---------------------------------------------------------------------------------


@query("top_overall", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def best_overall(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return top_overall(part, "p_retailprice", ["p_partkey"], 20)


@query("top_by_position", """SELECT c_mktsegment, c_custkey, c_acctbal, CAST(rn AS INTEGER) AS "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer
  WHERE c_mktsegment IN ('MACHINERY', 'BUILDING', 'HOUSEHOLD', 'NO SUCH SEGMENT', 'AUTOMOBILE')) WHERE rn <= 10""")
def best_by_position(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    wanted = ["MACHINERY", "BUILDING", "HOUSEHOLD", "NO SUCH SEGMENT", "AUTOMOBILE"]
    return top_by_group(customers, "c_mktsegment", "c_acctbal", ["c_custkey"], 10, wanted)


@query("repeated_event_days", """SELECT user_id, CAST(day(ts) AS INTEGER) AS gameweek, count(*) AS "rows" FROM events
  GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_event_days(spark, sf_dir):
    """Keys that are not unique: users with several events a day."""
    return repeated_keys(table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("gameweek")), ["user_id", "gameweek"])


@query("top_orders_by_priority", """SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 10""")
def top_orders_by_priority(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return top_by_group(orders, "o_orderpriority", "o_totalprice", ["o_orderkey"])


@query("preview_per_season", ROLES_SQL + """SELECT season, gameweek FROM (
  SELECT season, gameweek, row_number() OVER (PARTITION BY season ORDER BY gameweek) AS rn FROM (SELECT DISTINCT season, gameweek FROM panel))
  WHERE rn <= 20""")
def preview_per_season(spark, sf_dir):
    return first_periods(roles.panel(spark, sf_dir))


@query("distinct_periods", ROLES_SQL + "SELECT DISTINCT gameweek FROM panel")
def distinct_periods(spark, sf_dir):
    return sorted_distinct(roles.panel(spark, sf_dir), "gameweek")


@query("season_rows", ROLES_SQL + """SELECT count(*) AS "rows" FROM panel WHERE season = '2024-B'""")
def rows_of_season(spark, sf_dir):
    return season_rows(roles.panel(spark, sf_dir))


@query("panel_shape", ROLES_SQL + """SELECT count(*) AS "rows", CAST(13 AS INTEGER) AS columns FROM panel""")
def panel_shape(spark, sf_dir):
    return shape(roles.panel(spark, sf_dir))


@query("prepared_actuals", ROLES_SQL + "SELECT season, gameweek, id, event_points FROM panel WHERE season = '2024-B'")
def prepared_actuals(spark, sf_dir):
    """Actuals under other names and as text."""
    rows = roles.panel(spark, sf_dir).select(
        "season", F.col("gameweek").cast("string"), F.col("id").cast("string").alias("element"),
        F.col("event_points").cast("string").alias("total_points"),
    )
    return prepare_actuals(rows).select("season", "gameweek", "id", "event_points")


# --- reconciliation -------------------------------------------------------------------------------


def resolution(spark, sf_dir):
    names = one_season(roles.names(spark, sf_dir), roles.CURRENT)
    return resolve_ids(roles.naive_forecasts(spark, sf_dir), names)


@query("resolve_keys", ROLES_SQL + "SELECT gameweek, player_name, team_short, position, predicted_points, id FROM resolved WHERE id IS NOT NULL")
def resolve_keys(spark, sf_dir):
    return resolution(spark, sf_dir).resolved


@query("unresolved_keys", ROLES_SQL + "SELECT gameweek, player_name, team_short, position, predicted_points FROM resolved WHERE id IS NULL")
def unresolved_keys(spark, sf_dir):
    return resolution(spark, sf_dir).unresolved


@query("resolution_counts", ROLES_SQL + """SELECT CASE WHEN id IS NULL THEN 'unresolved' ELSE 'resolved' END AS outcome, count(*) AS "rows"
  FROM resolved GROUP BY 1""")
def resolution_counts(spark, sf_dir):
    return resolution(spark, sf_dir).counts()


@query("unresolved_samples", ROLES_SQL + "SELECT player_name, team_short FROM resolved WHERE id IS NULL ORDER BY 1, 2 LIMIT 10")
def unresolved_samples(spark, sf_dir):
    return resolution(spark, sf_dir).samples()


@query("reconcile_direct", ROLES_SQL + "SELECT * FROM direct")
def direct_route(spark, sf_dir):
    return reconcile_direct(roles.naive_forecasts(spark, sf_dir), roles.named_actuals(spark, sf_dir))


@query("reconcile_id", ROLES_SQL + "SELECT * FROM by_id")
def id_route(spark, sf_dir):
    return reconcile_by_id(resolution(spark, sf_dir).resolved, roles.named_actuals(spark, sf_dir))


@query("reconcile_routes", ROLES_SQL + "SELECT gameweek, forecasts, matched, direct FROM routes")
def routes(spark, sf_dir):
    forecasts = roles.naive_forecasts(spark, sf_dir)
    return period_routes(forecasts, reconcile_direct(forecasts, roles.named_actuals(spark, sf_dir)))


def reconciled(spark, sf_dir):
    """The forecasts are kept: both routes read them, and they stand for a table that exists already."""
    names = one_season(roles.names(spark, sf_dir), roles.CURRENT)
    forecasts = roles.naive_forecasts(spark, sf_dir).persist()
    rows = reconcile(forecasts, roles.named_actuals(spark, sf_dir), names)
    return rounded(rows, "error", "abs_error")


@query("reconcile_fallback", ROLES_SQL + "SELECT * FROM reconciled")
def reconcile_fallback(spark, sf_dir):
    return by_team_worst_first(reconciled(spark, sf_dir), ["gameweek", "id"])


@query("axis_limits", ROLES_SQL + """SELECT gameweek, team_short,
  CAST(floor(least(coalesce(min(predicted_points), 0), coalesce(min(event_points), 0)) - 0.5) AS BIGINT) AS lo,
  CAST(ceil(greatest(coalesce(max(predicted_points), 1), coalesce(max(event_points), 1)) + 0.5) AS BIGINT) AS hi
  FROM reconciled GROUP BY 1, 2""")
def limits(spark, sf_dir):
    return axis_limits(reconciled(spark, sf_dir))


@query("scatter_points", ROLES_SQL + """, limits AS (SELECT gameweek, team_short,
  CAST(floor(least(coalesce(min(predicted_points), 0), coalesce(min(event_points), 0)) - 0.5) AS BIGINT) AS lo,
  CAST(ceil(greatest(coalesce(max(predicted_points), 1), coalesce(max(event_points), 1)) + 0.5) AS BIGINT) AS hi
  FROM reconciled GROUP BY 1, 2)
  SELECT gameweek, team_short, player_name, predicted_points, event_points, lo, hi FROM reconciled JOIN limits USING (gameweek, team_short)""")
def points(spark, sf_dir):
    return scatter_points(reconciled(spark, sf_dir).persist())


@query("reconcile_known_keys", ROLES_SQL + "SELECT season, gameweek, id, player_name, team_short, position, predicted_points, event_points, error, abs_error FROM reconciled")
def reconcile_known_keys(spark, sf_dir):
    """The same rows through a dictionary of keys, built for the earlier periods and extended by the names of the later ones."""
    forecasts, actuals = roles.naive_forecasts(spark, sf_dir), roles.named_actuals(spark, sf_dir)
    names = roles.names(spark, sf_dir).where(F.col("season") == roles.CURRENT)
    early = F.col("gameweek") <= roles.CUTOFF
    base = versions.current(spark, scratch_path(spark, "keys"))
    base = extended(base, [forecasts.where(early), actuals.where(early), names], NAME_KEYS)
    base = extended(base, [forecasts.where(~early), actuals.where(~early)], NAME_KEYS)
    return rounded(reconcile(forecasts, actuals, names, known=known_keys(base)), "error", "abs_error")


@query("pending_periods", ROLES_SQL + """SELECT season, gameweek, id, event_points FROM panel p WHERE NOT EXISTS (
  SELECT 1 FROM panel d WHERE d.total_shots >= 4 AND d.gameweek = p.gameweek)""")
def pending_periods(spark, sf_dir):
    panel = roles.panel(spark, sf_dir)
    return pending(panel, panel.where("total_shots >= 4")).select("season", "gameweek", "id", "event_points")


# --- corrections ----------------------------------------------------------------------------------


def zeroed_panel(spark, sf_dir):
    """The panel with small targets set to 0."""
    points_ = F.when(F.col("event_points") < 40, F.lit(0.0)).otherwise(F.col("event_points"))
    return roles.panel(spark, sf_dir).select("season", "gameweek", "id", points_.alias("event_points"), "minutes")


def corrections(spark, sf_dir):
    """Second source: one file per event type, with several and also negative values per key."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.dayofmonth("ts").alias("gameweek"), F.round(F.col("value") - 5, 2).alias("event_points"),
        F.concat(F.lit("gw_"), F.col("event_type"), F.lit("-points.csv")).alias("file_name"),
    )


PATCH_SQL = ROLES_SQL + """, zeroed AS (
  SELECT season, gameweek, id, CASE WHEN event_points < 40 THEN 0.0::DOUBLE ELSE event_points END AS event_points, minutes FROM panel),
source AS (
  SELECT user_id AS id, CAST(day(ts) AS INTEGER) AS gameweek, round(value - 5, 2) AS points, 'gw_' || event_type || '-points.csv' AS file_name FROM events),
positive AS (
  SELECT id, gameweek, CAST(trunc(points) AS DOUBLE) AS api_points FROM (
    SELECT *, row_number() OVER (PARTITION BY id, gameweek ORDER BY points < 1, file_name, points) AS rn FROM source WHERE points > 0) WHERE rn = 1),
matched AS (
  SELECT z.*, api_points, k.id IS NOT NULL AS has_api, coalesce(season = '2024-B' AND event_points = 0 AND api_points IS NOT NULL, false) AS patch
  FROM zeroed z LEFT JOIN (SELECT DISTINCT id, gameweek FROM source) k ON k.id = z.id AND k.gameweek = z.gameweek
  LEFT JOIN positive p ON p.id = z.id AND p.gameweek = z.gameweek),
patched AS (
  SELECT season, gameweek, id, CASE WHEN patch THEN api_points ELSE event_points END AS event_points, minutes,
    CASE WHEN patch THEN event_points END AS event_points_orig FROM matched)
"""


@query("patch_zero", PATCH_SQL + "SELECT * FROM patched")
def patch_zero(spark, sf_dir):
    return patch_zero_targets(zeroed_panel(spark, sf_dir), corrections(spark, sf_dir))[0]


@query("patch_counts", PATCH_SQL + """SELECT gameweek, count(*) FILTER (WHERE has_api) AS with_second_source,
  count(*) FILTER (WHERE patch) AS updated FROM matched WHERE season = '2024-B' GROUP BY ROLLUP (gameweek)""")
def patch_counts(spark, sf_dir):
    return patch_zero_targets(zeroed_panel(spark, sf_dir), corrections(spark, sf_dir))[1]


@query("patch_versioned", PATCH_SQL + "SELECT * FROM patched")
def patch_versioned(spark, sf_dir):
    """The patch reads version 1 of a table and publishes version 2, which shares the folders of all periods that stay."""
    empty = versions.current(spark, scratch_path(spark, "panel-versions"))
    first = versions.commit(empty, {"panel": versions.Change(zeroed_panel(spark, sf_dir))})
    return patch_version(first, corrections(spark, sf_dir)).table("panel")


@query("patch_rewrites", PATCH_SQL + """, touched AS (SELECT season, gameweek, bool_or(patch) AS rewritten FROM matched GROUP BY 1, 2)
  SELECT season, gameweek, rewritten FROM touched""")
def patch_rewrites(spark, sf_dir):
    """Which periods a patch of a few corrections writes again; the others keep their folders."""
    empty = versions.current(spark, scratch_path(spark, "panel-versions"))
    first = versions.commit(empty, {"panel": versions.Change(zeroed_panel(spark, sf_dir))})
    second = patch_version(first, corrections(spark, sf_dir))
    before, after = first.folders("panel"), second.folders("panel")
    rows = [(p["season"], p["gameweek"], before[k] != after[k]) for k in after for p in [json.loads(k)]]
    return spark.createDataFrame(rows, "season string, gameweek int, rewritten boolean")
