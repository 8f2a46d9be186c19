import pytest
from pyspark.sql import functions as F

from panelcast.operators.enrich import attach_context, attach_fixtures, attach_names, entity_names, left_lookup
from panelcast.operators.pairs import keep_competition, team_rows
from panelcast.operators.patch import patch_zero_targets
from panelcast.operators.rank import first_periods, sorted_distinct, top_by_group, top_overall
from panelcast.operators.reconcile import period_routes, reconcile, resolve_ids
from panelcast.operators.report import (
    axis_limits,
    by_team_worst_first,
    mean_absolute_error,
    pending,
    scatter_points,
    with_errors,
    worst_first,
)
from panelcast.operators.snapshot import (
    current_form,
    last_period,
    latest_rows,
    latest_season,
    next_period_rows,
    sum_by_entity,
)
from panelcast.plans.model_table import engineered, model_table
from panelcast.session import checked_broadcast


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


MATCHES = [
    ("s", 1, "10", "20", "1500.5", "1600", "Premier League", "x"),
    ("s", 1, "10", "30", "1500.5", "1400", "PREMIERSHIP", "x"),
    ("s", 1, "20", "30", "1", "2", "cup", "x"),
    ("s", 1, "30", None, "1", "2", "premier", "x"),
    ("s", 1, "bad", "20", "1", "2", "premier", "x"),
    ("s", 1, "20", "30", "1", "2", None, "x"),
    ("s", 2, "30", "10", "n/a", "1510", "prem", "x"),
]
MATCH_SCHEMA = ("season string, gameweek int, home_team string, away_team string, home_team_elo string, "
                "away_team_elo string, tournament string, match_id string")


@pytest.fixture
def fixtures(spark):
    return team_rows(keep_competition(spark.createDataFrame(MATCHES, MATCH_SCHEMA)))


def test_each_match_gives_two_rows(fixtures):
    assert rows(fixtures) == sorted([
        ("s", 1, 10, 20, 1, 1500.5, 1600.0), ("s", 1, 20, 10, 0, 1600.0, 1500.5),
        ("s", 1, 10, 30, 1, 1500.5, 1400.0), ("s", 1, 30, 10, 0, 1400.0, 1500.5),
        ("s", 2, 30, 10, 1, None, 1510.0), ("s", 2, 10, 30, 0, 1510.0, None),
    ], key=repr)


def test_competition_column_falls_back(spark):
    df = spark.createDataFrame(MATCHES, MATCH_SCHEMA)
    assert keep_competition(df.drop("tournament")).count() == 0
    assert keep_competition(df.drop("tournament").withColumn("match_id", F.lit("24-PREM-1"))).count() == 7
    assert keep_competition(df.drop("tournament", "match_id")).count() == 7
    assert keep_competition(df).count() == 5


MEMBERS = [("s", 1, 10, "Forward", "Ann"), ("s", 2, 20, "Defender", "Bo"), ("s", 3, 40, "Defender", "Cy"), ("s", 4, 99, None, None)]
STRENGTHS = [("s", 10, "TEN", 5.0, 6.0), ("s", 20, "TWE", 7.0, 8.0), ("s", 30, "THI", None, 9.0)]


@pytest.fixture
def members(spark):
    return spark.createDataFrame(MEMBERS, "season string, player_id long, team_code long, position string, web_name string")


@pytest.fixture
def strengths(spark):
    return spark.createDataFrame(STRENGTHS, "season string, team_code long, team_short string, strength_defence_home double, strength_defence_away double")


def test_context_fans_out_and_picks_the_side(spark, members, fixtures, strengths):
    panel = spark.createDataFrame([("s", 1, 1), ("s", 2, 1), ("s", 3, 1), ("s", 7, 1), ("s", 1, 2)], "season string, id long, gameweek int")
    got = rows(attach_context(panel, members, fixtures, strengths), "id", "gameweek", "opp_code", "is_home", "opp_def_strength")
    assert got == sorted([
        (1, 1, 20, 1, 8.0), (1, 1, 30, 1, 9.0),  # two fixtures at home: the opponents' away strengths
        (2, 1, 10, 0, 5.0),  # away: the opponent's home strength
        (3, 1, None, None, None), (7, 1, None, None, None),  # no fixture; unknown entity
        (1, 2, 30, 0, None),  # away to a team without a home strength
    ], key=repr)


def test_clashing_columns_get_a_suffix(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([(1, "b")], "k int, v string")
    assert left_lookup(left, right, ["k"], suffix="_fixture").columns == ["k", "v", "v_fixture"]
    fixture = spark.createDataFrame([("s", 1, 10, 5)], "season string, gameweek int, team_code long, minutes int")
    panel = spark.createDataFrame([("s", 1, 10, 90)], "season string, gameweek int, team_code long, minutes int")
    assert attach_fixtures(panel, fixture).first()["minutes"] == 90


def test_names(spark, members, strengths):
    names = entity_names(members, strengths)
    assert rows(names.where("player_id = 4")) == [("s", 4, None, None, None)]
    named = attach_names(spark.createDataFrame([("s", 1), ("s", 9)], "season string, id long"), names)
    assert rows(named) == sorted([("s", 1, "Ann", "TEN", "Forward"), ("s", 9, None, None, None)], key=repr)


def test_broadcast_is_checked(spark):
    small = checked_broadcast(spark.range(10), max_rows=10)
    large = checked_broadcast(spark.range(11), max_rows=10)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()


PANEL = [
    ("s", 1, 1, 2.0, 90.0, "4.0", "10%", "1"), ("s", 1, 2, 4.0, 60.0, "4.1", "11%", "2"), ("s", 1, 4, 6.0, 59.0, "4.2", "12%", "x"),
    ("s", 1, 5, None, None, "4.3", "12.3%", None), ("s", 2, 2, 1.0, 10.0, "5", "1%", "3"), ("r", 2, 9, 8.0, 90.0, "6", "2%", "4"),
]
PANEL_SCHEMA = ("season string, id long, gameweek int, event_points double, minutes double, now_cost string, "
                "selected_by_percent string, form string")


@pytest.fixture
def panel(spark):
    return spark.createDataFrame(PANEL, PANEL_SCHEMA)


def test_current_form_keeps_nulls_of_the_latest_row(panel):
    form = {(r["season"], r["id"]): r for r in current_form(panel).collect()}
    one = form["s", 1]
    assert one["pts_prev_gw"] is None and one["form"] is None and one["selected_by_percent"] == "12.3%"
    assert one["pts_avg_last3"] == 5.0 and one["mins_avg_last3"] == 59.5 and one["played60_rate_last3"] == pytest.approx(1 / 3)
    assert form["s", 2]["pts_prev_gw"] == 1.0 and form["s", 2]["mins_avg_last3"] == 10.0
    assert rows(current_form(panel.drop("form")).where("id = 1"), "form") == [(None,)]


def test_latest(panel):
    assert rows(latest_rows(panel, ["season", "id"], ["gameweek"]), "season", "id", "gameweek") == [("r", 2, 9), ("s", 1, 5), ("s", 2, 2)]
    assert {r["season"] for r in latest_season(panel).collect()} == {"s"}
    assert rows(last_period(panel)) == [("s", 5, 6)]


def test_next_period_rows(panel, members, fixtures, strengths):
    upcoming = fixtures.withColumn("gameweek", F.col("gameweek") + 5)
    got = next_period_rows(panel, members, upcoming, strengths)
    assert rows(got, "gameweek", "id", "opp_code", "selected_by_percent", "form", "now_cost") == sorted([
        (6, 1, 20, 12.3, None, 4.3), (6, 1, 30, 12.3, None, 4.3), (6, 2, 10, 1.0, 3.0, 5.0)], key=repr)
    earlier = next_period_rows(panel, members, upcoming.withColumn("gameweek", F.lit(3)), strengths, season="s", last_gw=2)
    assert rows(earlier.select("id", "pts_prev_gw").distinct()) == [(1, 4.0), (2, 1.0)]
    double = got.withColumn("predicted_points", F.lit(2.5))
    assert rows(sum_by_entity(double), "id", "predicted_points", "fixtures") == [(1, 5.0, 2), (2, 2.5, 1)]


def test_double_fixture_does_not_see_itself(spark, members, fixtures, strengths):
    history = spark.createDataFrame(
        [("s", 1, 0, 1.0, 90.0), ("s", 1, 1, 7.0, 90.0)],
        "season string, id long, gameweek int, event_points double, minutes double")
    columns = ["id", "gameweek", "opp_code", "pts_prev_gw"]
    assert rows(model_table(history, members, fixtures, strengths), *columns) == [(1, 1, 20, 1.0), (1, 1, 30, 1.0)]
    leaking = model_table(history, members, fixtures, strengths, fixtures_first=True)
    assert rows(leaking, *columns) == [(1, 1, 20, 1.0), (1, 1, 30, 7.0)]


def test_engineered_columns(spark):
    df = spark.createDataFrame([(1600.0, 1500.0, "2.5", 1)], "team_elo double, opp_elo double, form string, is_home int")
    assert rows(engineered(df), "elo_diff", "form_x_home") == [(100.0, 2.5)]
    bare = engineered(df.drop("opp_elo", "form"))
    assert rows(bare, "elo_diff", "form_x_home") == [(None, None)] and "form" not in bare.columns


# --- patch ----------------------------------------------------------------------------------------

SOURCE_SCHEMA = "file_name string, id long, gameweek int, event_points double"


def patch(spark, sources, data, schema="season string, id long, gameweek int, event_points double"):
    return patch_zero_targets(spark.createDataFrame(data, schema), spark.createDataFrame(sources, SOURCE_SCHEMA))


def test_patch(spark):
    data = [("a", 1, 1, 0.0), ("b", 1, 1, 0.0), ("b", 2, 1, 3.0), ("b", 3, 1, 0.0), ("b", 4, 1, 0.0), ("b", 5, 1, 0.0),
            ("b", 6, 2, 0.0), ("b", 7, 2, None), ("b", 8, 2, 0.0)]
    sources = [
        ("gw2-points.csv", 1, 1, 9.0), ("gw10-points.csv", 1, 1, 5.0),  # gw10 comes first by name
        ("gw1-points.csv", 2, 1, 8.0),  # old value is not 0
        ("gw1-points.csv", 3, 1, 0.0), ("gw1-points.csv", 4, 1, -2.0),  # nothing positive
        ("gw1-points.csv", 6, 2, 4.0), ("gw1-points.csv", 6, 2, 4.0),  # duplicate key
        ("gw1-points.csv", 7, 2, 4.0),  # target missing
        ("gw1-points.csv", 8, 2, 0.5), ("gw2-points.csv", 8, 2, 3.7),  # cut to 0, then to 3
        ("gw1-points.csv", 99, 2, 4.0), ("gw1-points.csv", 5, 1, None),
    ]
    patched, counts = patch(spark, sources, data)
    assert rows(patched) == sorted([
        ("a", 1, 1, 0.0, None), ("b", 1, 1, 5.0, 0.0), ("b", 2, 1, 3.0, None), ("b", 3, 1, 0.0, None), ("b", 4, 1, 0.0, None),
        ("b", 5, 1, 0.0, None), ("b", 6, 2, 4.0, 0.0), ("b", 7, 2, None, None), ("b", 8, 2, 3.0, 0.0)], key=repr)
    assert rows(counts) == sorted([(None, 7, 3), (1, 4, 1), (2, 3, 2)], key=repr)
    again, counts = patch_zero_targets(patched, spark.createDataFrame(sources, SOURCE_SCHEMA))
    assert rows(again) == rows(patched)
    assert counts.where("gameweek is null").first()["updated"] == 0


# --- reconcile ------------------------------------------------------------------------------------


def names_table(spark, data):
    return spark.createDataFrame(data, "season string, player_id long, player_name string, team_short string, position string")


def forecast_table(spark, data):
    return spark.createDataFrame(data, "gameweek int, player_name string, team_short string, position string, predicted_points double")


def test_resolution(spark):
    names = names_table(spark, [("s", 1, "Šeško", "MUN", "F"), ("s", 2, "Ødegaard", "ARS", "M"), ("s", 3, "Twin", "A", "M"),
                                ("s", 4, "Twin", "A", "M"), ("s", 5, None, "A", "M")])
    forecasts = forecast_table(spark, [(1, " sesko", "mun ", "F", 1.0), (1, "Odegaard", "ARS", "M", 2.0), (1, "twin", "a", "M", 3.0),
                                       (1, None, "A", "M", 4.0)])
    got = resolve_ids(forecasts, names)
    assert rows(got.resolved, "id", "predicted_points") == [(1, 1.0), (3, 3.0), (4, 3.0)]
    assert rows(got.unresolved, "predicted_points") == [(2.0,), (4.0,)]
    assert rows(got.counts()) == [("ambiguous", 1), ("resolved", 3), ("unresolved", 2)]
    assert got.samples(1).count() == 1


def test_coverage_decides_per_period(spark):
    """Ten forecasts per period; 7, 6 and 0 direct matches; period 4 has one forecast and one match."""
    ids = range(1, 11)
    names = names_table(spark, [("s", i, f"P{i}", "T", "M") for i in ids])
    forecasts = forecast_table(spark, [(gw, f"p{i}", "t", "M", 1.0) for gw in (1, 2, 3) for i in ids] + [(4, "P1", "T", "M", 1.0)])
    direct = {1: 7, 2: 6, 3: 0, 4: 10}
    actuals = [("s", gw, i, 3.0, f"P{i}" if i <= direct[gw] else "other", "T") for gw in direct for i in ids]
    actuals = spark.createDataFrame(actuals, "season string, gameweek int, id long, event_points double, player_name string, team_short string")
    merged = reconcile(forecasts, actuals, names)
    assert rows(merged.groupBy("gameweek").count()) == [(1, 7), (2, 10), (3, 10), (4, 1)]
    assert rows(merged.select("season", "error", "abs_error").distinct()) == [("s", -2.0, 2.0)]
    assert rows(merged.groupBy("gameweek", "id").count().where("count > 1")) == []
    by_id = reconcile(forecasts, actuals.drop("player_name", "team_short"), names)
    assert rows(by_id.groupBy("gameweek").count()) == [(1, 10), (2, 10), (3, 10), (4, 1)]


def test_one_match_is_the_least(spark):
    forecasts = forecast_table(spark, [(1, "a", "t", "M", 1.0)])
    none = spark.createDataFrame([], "gameweek int")
    assert rows(period_routes(forecasts, none)) == [(1, 1, 0, False)]


# --- ranks and reports ----------------------------------------------------------------------------


def test_ranks(spark):
    df = spark.createDataFrame([(1, "F", 8.12), (2, "F", 8.12), (3, "D", None), (4, "D", 1.0), (5, "G", 3.0), (6, "X", 99.0)],
                               "id int, position string, p double")
    assert [r["id"] for r in top_overall(df, "p", ["id"], 3).collect()] == [6, 1, 2]
    assert [r["id"] for r in top_overall(df, "p", ["id"], 9).collect()][-1] == 3
    best = top_by_group(df, "position", "p", ["id"], 1, ["G", "D", "M", "F"])
    assert [(r["position"], r["id"], r["rank"]) for r in best.collect()] == [("G", 5, 1), ("D", 4, 1), ("F", 1, 1)]
    assert top_by_group(df, "position", "p", ["id"], 2).count() == 6


def test_periods(spark):
    df = spark.createDataFrame([(s, g) for s in "ab" for g in range(30, 0, -1)] * 2, "season string, gameweek int")
    assert first_periods(df).groupBy("season").agg(F.count("*"), F.max("gameweek")).orderBy("season").collect() == [("a", 20, 20), ("b", 20, 20)]
    assert [r[0] for r in sorted_distinct(df, "season").collect()] == ["a", "b"]
    done = spark.createDataFrame([(1,), (2,)], "gameweek int")
    assert pending(df, done).select("gameweek").distinct().count() == 28


def test_reports(spark):
    df = spark.createDataFrame(
        [(1, "B", "x", 2.0, 5.0), (1, "A", "y", 1.2, 1.0), (1, "A", "z", 4.0, -1.0), (1, None, "w", 1.0, 1.0), (1, "C", "v", None, None)],
        "gameweek int, team_short string, player_name string, predicted_points double, event_points double")
    errors = with_errors(df)
    assert [r["player_name"] for r in worst_first(errors, ["player_name"]).collect()] == ["z", "x", "y", "w", "v"]
    assert [r["player_name"] for r in by_team_worst_first(errors, ["player_name"]).collect()] == ["z", "y", "x", "v", "w"]
    assert rows(mean_absolute_error(df)) == [(pytest.approx(8.2 / 4), 4)]
    limits = {r["team_short"]: (r["lo"], r["hi"]) for r in axis_limits(df.na.drop(subset=["team_short"])).collect()}
    assert limits == {"B": (1, 6), "A": (-2, 5), "C": (-1, 2)}
    assert rows(scatter_points(df), "player_name", "lo", "hi") == [("v", -1, 2), ("x", 1, 6), ("y", -2, 5), ("z", -2, 5)]
