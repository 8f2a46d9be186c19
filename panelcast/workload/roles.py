"""The roles of a forecasting panel played by the driver's tables, as DataFrames and as SQL.

panel: ``events`` per season, user and day. members: customers. teams: nations with supplier figures.
matches: every nation hosts one match per period; half of them belong to the competition that counts,
so some teams have no fixture in a period and some have two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.conform import percent_columns
from panelcast.operators.enrich import entity_names
from panelcast.operators.pairs import keep_competition, team_rows
from panelcast.operators.rolling import FORM_LAST3, rolling_features, with_form_inputs
from panelcast.plans.model_table import model_table

SEASONS = ("2024-A", "2024-B")
PERIODS = 31
CURRENT = "2024-B"
CUTOFF = 25
EVAL_PERIOD = 30


# Declared, so that no job has to read file footers for a schema.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def season_of(period: Column) -> Column:
    return F.when(period <= 15, F.lit(SEASONS[0])).otherwise(F.lit(SEASONS[1]))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per season, user and day. Sums are rounded to cents, so their order does not matter."""
    events = table(spark, sf_dir, "events").withColumn("gameweek", F.dayofmonth("ts"))

    def value_of(kind: str) -> Column:
        return F.round(F.sum(F.when(F.col("event_type") == kind, F.col("value"))), 2)

    def count_of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind)

    key = F.get_json_object("props", "$.k").cast("int")
    return (
        events.groupBy(season_of(F.col("gameweek")).alias("season"), F.col("user_id").alias("id"), "gameweek")
        .agg(
            F.round(F.sum(F.when(F.col("event_type") != "signup", F.col("value"))), 2).alias("event_points"),
            (20 * F.count(F.lit(1))).cast("double").alias("minutes"),
            value_of("click").alias("expected_goals"),
            value_of("view").alias("expected_assists"),
            count_of("error").cast("double").alias("goals_conceded"),
            (count_of("error") == 0).cast("double").alias("clean_sheets"),
            count_of("purchase").cast("double").alias("total_shots"),
            F.max("value").cast("string").alias("now_cost"),
            F.concat((10 * F.count(F.lit(1))).cast("string"), F.lit("%")).alias("selected_by_percent"),
            F.when(count_of("view") == 0, F.lit("n/a")).otherwise(F.max(key).cast("string")).alias("form"),
        )
    )


PANEL_SQL = """panel AS (
  SELECT CASE WHEN day(ts) <= 15 THEN '2024-A' ELSE '2024-B' END AS season,
    user_id AS id, CAST(day(ts) AS INTEGER) AS gameweek,
    round(sum(value) FILTER (WHERE event_type <> 'signup'), 2) AS event_points,
    CAST(20 * count(*) AS DOUBLE) AS minutes,
    round(sum(value) FILTER (WHERE event_type = 'click'), 2) AS expected_goals,
    round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS expected_assists,
    CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS goals_conceded,
    CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS clean_sheets,
    CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS total_shots,
    CAST(max(value) AS VARCHAR) AS now_cost,
    CAST(10 * count(*) AS VARCHAR) || '%' AS selected_by_percent,
    CASE WHEN count(*) FILTER (WHERE event_type = 'view') = 0 THEN 'n/a'
      ELSE CAST(max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS VARCHAR) END AS form
  FROM events GROUP BY 1, 2, 3)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.explode(F.array(*map(F.lit, SEASONS))).alias("season"),
        F.col("c_custkey").alias("player_id"),
        F.col("c_nationkey").cast("long").alias("team_code"),
        F.col("c_mktsegment").alias("position"),
        F.col("c_name").alias("web_name"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the mean and the greatest balance of their suppliers as strengths."""
    strength = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        (F.round(F.sum("s_acctbal"), 2) / F.count(F.lit(1))).alias("strength_defence_home"),
        F.max("s_acctbal").alias("strength_defence_away"),
    )
    nation = table(spark, sf_dir, "nation")
    return nation.join(strength, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        F.explode(F.array(*map(F.lit, SEASONS))).alias("season"),
        F.col("n_nationkey").cast("long").alias("team_code"),
        F.col("n_name").alias("team_short"),
        "strength_defence_home",
        "strength_defence_away",
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match with the ratings of both sides (mean customer balance of the nation)."""
    rating = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        (F.round(F.sum("c_acctbal"), 2) / F.count(F.lit(1))).alias("elo")
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("home_team"))
    gw = F.col("gameweek")
    schedule = nation.withColumn("gameweek", F.explode(F.sequence(F.lit(1), F.lit(PERIODS)))).select(
        season_of(gw).alias("season"),
        "gameweek",
        "home_team",
        F.pmod(F.col("home_team") + 2 * gw + 1, F.lit(25)).cast("long").alias("away_team"),
        F.element_at(
            F.array(F.lit("Premier Division"), F.lit("Cup"), F.lit("second PREMIER tier"), F.lit(None)),
            F.pmod(F.col("home_team") + gw, F.lit(4)).cast("int") + 1,
        ).alias("tournament"),
    ).where("home_team <> away_team")
    for side in ("home", "away"):
        sided = rating.select(F.col("c_nationkey").cast("long").alias(f"{side}_team"), F.col("elo").alias(f"{side}_team_elo"))
        schedule = schedule.join(sided, [f"{side}_team"], "left")
    return schedule


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_rows(keep_competition(matches(spark, sf_dir)))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_names(members(spark, sf_dir), teams(spark, sf_dir))


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """members, fixtures, strengths"""
    return members(spark, sf_dir), fixtures(spark, sf_dir), teams(spark, sf_dir)


def form_model(spark: SparkSession, sf_dir: str, specs=FORM_LAST3, **options) -> DataFrame:
    """The model table with cleaned snapshot columns."""
    model = model_table(panel(spark, sf_dir), *dimensions(spark, sf_dir), specs=specs, **options)
    return percent_columns(model, ("now_cost", "selected_by_percent", "form"))


def naive_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast = mean of the last three targets, for the current season, with names in other letters."""
    rolled = rolling_features(with_form_inputs(panel(spark, sf_dir)))
    rows = rolled.where((F.col("season") == CURRENT) & F.col("pts_avg_last3").isNotNull())
    named = rows.join(names(spark, sf_dir).withColumnRenamed("player_id", "id").hint("merge"), ["season", "id"])
    suffix = F.when(F.col("position") == "BUILDING", F.lit(" jr")).otherwise(F.lit(""))
    return named.select(
        "gameweek",
        F.concat(F.lit("  "), F.translate(F.upper("player_name"), "UOE", "ÜÖÉ"), suffix).alias("player_name"),
        F.concat(F.translate(F.lower("team_short"), "ao", "äó"), F.lit(" ")).alias("team_short"),
        "position",
        F.round("pts_avg_last3", 6).alias("predicted_points"),
    )


def named_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the current season with names; in every third period half of the names are misspelt."""
    rows = panel(spark, sf_dir).where(F.col("season") == CURRENT).select("season", "gameweek", "id", "event_points")
    named = rows.join(names(spark, sf_dir).withColumnRenamed("player_id", "id").hint("merge"), ["season", "id"])
    misspelt = (F.col("gameweek") % 3 == 0) & (F.col("id") % 2 == 0)
    return named.select(
        "season", "gameweek", "id", "event_points",
        F.when(misspelt, F.concat(F.lit("x"), F.col("player_name"))).otherwise(F.col("player_name")).alias("player_name"),
        "team_short",
    )


ROLES_SQL = f"""WITH {PANEL_SQL},
seasons AS (SELECT unnest(['2024-A', '2024-B']) AS season),
members AS (
  SELECT season, c_custkey AS player_id, CAST(c_nationkey AS BIGINT) AS team_code, c_mktsegment AS position, c_name AS web_name
  FROM customer, seasons),
teams AS (
  SELECT season, CAST(n_nationkey AS BIGINT) AS team_code, n_name AS team_short, strength_defence_home, strength_defence_away
  FROM nation LEFT JOIN (
    SELECT s_nationkey, round(sum(s_acctbal), 2) / count(*) AS strength_defence_home, max(s_acctbal) AS strength_defence_away
    FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey, seasons),
rating AS (SELECT c_nationkey, round(sum(c_acctbal), 2) / count(*) AS elo FROM customer GROUP BY 1),
schedule AS (
  SELECT CASE WHEN gw <= 15 THEN '2024-A' ELSE '2024-B' END AS season, CAST(gw AS INTEGER) AS gameweek,
    CAST(n_nationkey AS BIGINT) AS home_team, CAST((n_nationkey + 2 * gw + 1) % 25 AS BIGINT) AS away_team,
    CASE (n_nationkey + gw) % 4 WHEN 0 THEN 'Premier Division' WHEN 1 THEN 'Cup' WHEN 2 THEN 'second PREMIER tier' END AS tournament
  FROM nation, range(1, 32) g(gw)),
matches AS (
  SELECT s.*, h.elo AS home_team_elo, a.elo AS away_team_elo
  FROM schedule s LEFT JOIN rating h ON h.c_nationkey = home_team LEFT JOIN rating a ON a.c_nationkey = away_team
  WHERE home_team <> away_team),
league AS (SELECT * FROM matches WHERE tournament ILIKE '%prem%'),
fixtures AS (
  SELECT season, gameweek, home_team AS team_code, away_team AS opp_code, 1 AS is_home, home_team_elo AS team_elo, away_team_elo AS opp_elo FROM league
  UNION ALL
  SELECT season, gameweek, away_team, home_team, 0, away_team_elo, home_team_elo FROM league),
names AS (
  SELECT m.season, player_id, web_name AS player_name, team_short, position
  FROM members m LEFT JOIN teams t ON m.season = t.season AND m.team_code = t.team_code),
form_inputs AS (
  SELECT *, CASE WHEN minutes >= 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS played60,
    coalesce(expected_goals, 0) + coalesce(expected_assists, 0) AS xgi
  FROM panel),
rolled AS (
  SELECT *, lag(event_points) OVER k AS pts_prev_gw,
    avg(event_points) OVER w3 AS pts_avg_last3, avg(event_points) OVER w5 AS pts_avg_last5,
    avg(minutes) OVER w3 AS mins_avg_last3, avg(minutes) OVER w5 AS mins_avg_last5,
    avg(played60) OVER w3 AS played60_rate_last3, avg(played60) OVER w5 AS played60_rate_last5,
    avg(xgi) OVER w3 AS xgi_avg_last3, avg(xgi) OVER w5 AS xgi_avg_last5,
    sum(total_shots) OVER w3 AS shots_last3, sum(total_shots) OVER w5 AS shots_last5,
    avg(clean_sheets) OVER w3 AS cs_rate_last3, avg(clean_sheets) OVER w5 AS cs_rate_last5,
    avg(goals_conceded) OVER w3 AS gc_avg_last3, avg(goals_conceded) OVER w5 AS gc_avg_last5
  FROM form_inputs
  WINDOW k AS (PARTITION BY season, id ORDER BY gameweek),
    w3 AS (PARTITION BY season, id ORDER BY gameweek ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
    w5 AS (PARTITION BY season, id ORDER BY gameweek ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
context AS (
  SELECT r.*, m.team_code, f.opp_code, f.is_home, f.team_elo, f.opp_elo,
    CASE WHEN f.is_home = 1 THEN t.strength_defence_away WHEN f.is_home = 0 THEN t.strength_defence_home END AS opp_def_strength
  FROM rolled r
  LEFT JOIN members m ON m.season = r.season AND m.player_id = r.id
  LEFT JOIN fixtures f ON f.season = r.season AND f.gameweek = r.gameweek AND f.team_code = m.team_code
  LEFT JOIN teams t ON t.season = r.season AND t.team_code = f.opp_code),
model AS (
  SELECT * REPLACE (TRY_CAST(now_cost AS DOUBLE) AS now_cost,
    TRY_CAST(replace(selected_by_percent, '%', '') AS DOUBLE) AS selected_by_percent,
    TRY_CAST(form AS DOUBLE) AS form)
  FROM context WHERE pts_prev_gw IS NOT NULL AND opp_def_strength IS NOT NULL AND event_points IS NOT NULL),
forecasts AS (
  SELECT gameweek,
    '  ' || translate(upper(player_name), 'UOE', 'ÜÖÉ') || CASE WHEN position = 'BUILDING' THEN ' jr' ELSE '' END AS player_name,
    translate(lower(team_short), 'ao', 'äó') || ' ' AS team_short, position, round(pts_avg_last3, 6) AS predicted_points
  FROM rolled r JOIN names n ON n.season = r.season AND n.player_id = r.id
  WHERE r.season = '2024-B' AND pts_avg_last3 IS NOT NULL),
actuals AS (
  SELECT p.season, gameweek, id, event_points,
    CASE WHEN gameweek % 3 = 0 AND id % 2 = 0 THEN 'x' ELSE '' END || player_name AS player_name, team_short
  FROM panel p JOIN names n ON n.season = p.season AND n.player_id = p.id WHERE p.season = '2024-B'),
forecast_keys AS (
  SELECT *, strip_accents(lower(trim(player_name))) AS name_key, strip_accents(lower(trim(team_short))) AS team_key FROM forecasts),
resolved AS (
  SELECT f.*, player_id AS id FROM forecast_keys f LEFT JOIN names n
    ON n.season = '2024-B' AND name_key = strip_accents(lower(trim(n.player_name))) AND team_key = strip_accents(lower(trim(n.team_short)))),
direct AS (
  SELECT a.season, f.gameweek, a.id, f.player_name, f.team_short, position, predicted_points, event_points
  FROM forecast_keys f JOIN actuals a ON a.gameweek = f.gameweek
    AND name_key = strip_accents(lower(trim(a.player_name))) AND team_key = strip_accents(lower(trim(a.team_short)))),
by_id AS (
  SELECT a.season, r.gameweek, r.id, r.player_name, r.team_short, position, predicted_points, event_points
  FROM resolved r JOIN actuals a ON a.gameweek = r.gameweek AND a.id = r.id),
routes AS (
  SELECT gameweek, forecasts, coalesce(matched, 0) AS matched,
    coalesce(matched, 0) >= greatest(1, floor(0.7 * forecasts)) AS direct
  FROM (SELECT gameweek, count(*) AS forecasts FROM forecasts GROUP BY 1)
  LEFT JOIN (SELECT gameweek, count(*) AS matched FROM direct GROUP BY 1) USING (gameweek)),
reconciled AS (
  SELECT *, round(predicted_points - event_points, 6) AS error, round(abs(predicted_points - event_points), 6) AS abs_error
  FROM (SELECT d.* FROM direct d JOIN routes r ON r.gameweek = d.gameweek AND r.direct
    UNION ALL SELECT b.* FROM by_id b JOIN routes r ON r.gameweek = b.gameweek AND NOT r.direct))
"""
