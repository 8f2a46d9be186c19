"""Queries for casts, pairs, joins, rolling features, snapshots and the model table."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import casts
from panelcast.functions.features import reached, total_of
from panelcast.functions.paths import path_part, period_from_name
from panelcast.functions.text import comparison_key, contains_ignoring_case, safe_tag
from panelcast.operators import conform as cf
from panelcast.operators.carry import advance, state_columns
from panelcast.operators.enrich import attach_names, attach_team, left_lookup
from panelcast.operators.pairs import keep_competition, team_rows
from panelcast.operators.rolling import FORM_ALL, FORM_LAST3, HOT_ROWS, Lag, Roll, rolling_features, with_form_inputs
from panelcast.operators.snapshot import current_form, last_period, latest_rows, next_period_rows
from panelcast.plans.model_table import EXTENDED_BASIC, MODEL_COLUMNS, engineered, model_table, time_split
from panelcast.session import scratch_name, scratch_path
from panelcast.sources import versions
from panelcast.sources.bucketed import write_bucketed
from panelcast.sources.tree import PERIOD_PATH, one_season
from panelcast.workload import roles
from panelcast.workload.registry import query
from panelcast.workload.roles import ROLES_SQL, rounded, table

LAST3 = ("pts_prev_gw", "pts_avg_last3", "mins_avg_last3", "played60_rate_last3")
ALL_FORM = tuple(spec.name for spec in FORM_ALL)
WIDE_MODEL = ("season", "gameweek", "id", *ALL_FORM, *EXTENDED_BASIC[4:], "minutes", "event_points")


def sql_rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


# --- casts, projections, scalar functions ---------------------------------------------------------

TEXTS = """CASE l_linenumber % 7 WHEN 0 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5%'
  WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) WHEN 2 THEN 'nan' WHEN 3 THEN '1d'
  WHEN 4 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' ' WHEN 5 THEN '1,000' ELSE '' END"""


def number_texts(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int").cast("string")
    choices = [
        F.concat(quantity, F.lit(".5%")), quantity, F.lit("nan"), F.lit("1d"),
        F.concat(F.lit(" "), quantity, F.lit(" ")), F.lit("1,000"), F.lit(""),
    ]
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.element_at(F.array(*choices), F.col("l_linenumber") % 7 + 1).alias("text")
    )


@query("lenient_cast", f"""SELECT l_orderkey, l_linenumber, t AS text,
  CASE WHEN regexp_full_match(trim(t), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim(t) AS DOUBLE) END AS number
  FROM (SELECT *, {TEXTS} AS t FROM lineitem)""")
def lenient_cast(spark, sf_dir):
    return number_texts(spark, sf_dir).withColumn("number", casts.text_to_number(F.col("text")))


@query("percent_clean", f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN regexp_full_match(trim(t), '[0-9]+(\\.[0-9]+)?') THEN TRY_CAST(trim(t) AS DOUBLE) END AS number
  FROM (SELECT l_orderkey, l_linenumber, replace({TEXTS}, '%', '') AS t FROM lineitem)""")
def percent_clean(spark, sf_dir):
    cleaned = cf.percent_columns(number_texts(spark, sf_dir), ["text", "not_there"])
    return cleaned.withColumnRenamed("text", "number")


@query("strict_int", "SELECT p_partkey, p_size AS size_text, CAST(trunc(p_retailprice) AS INTEGER) AS price FROM part")
def strict_int(spark, sf_dir):
    texts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("string").alias("size_text"), F.col("p_retailprice").alias("price")
    )
    return cf.strict_int(texts, ["size_text", "price"])


@query("conform_columns", """SELECT c_custkey AS player_id, CAST(c_nationkey AS BIGINT) AS team_code, c_name AS web_name,
  CAST(NULL AS DOUBLE) AS form, c_mktsegment AS position FROM customer""")
def conform_columns(spark, sf_dir):
    rows = cf.resolve_alias(table(spark, sf_dir, "customer"), "player_id", ["element", "c_custkey"])
    rows = rows.withColumnsRenamed({"c_nationkey": "team_code", "c_name": "web_name", "c_mktsegment": "position"})
    rows = cf.conform(rows, {"player_id": "long", "team_code": "long", "form": "double"}, on_missing="null")
    return cf.keep_existing(cf.require(rows, ["player_id"]), ["player_id", "team_code", "web_name", "form", "position", "photo"])


@query("union_missing_columns", """SELECT * FROM (
  SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
  UNION ALL BY NAME SELECT s_suppkey AS key, s_nationkey AS nation, s_name AS name, s_acctbal AS balance FROM supplier)""")
def union_missing_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey key", "c_name name", "c_nationkey nation", "c_mktsegment segment")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey key", "s_nationkey nation", "s_name name", "s_acctbal balance")
    return customer.unionByName(supplier, allowMissingColumns=True)


@query("comparison_keys", "SELECT doc_id, strip_accents(lower(trim(text, ' ' || chr(10)))) AS key FROM documents")
def comparison_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", comparison_key(F.col("text")).alias("key"))


@query("safe_tag", """SELECT doc_id,
  coalesce(nullif(trim(regexp_replace(strip_accents(text), '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'UNK') AS tag FROM documents""")
def safe_tags(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", safe_tag(F.col("text")).alias("tag"))


@query("contains_ignoring_case", "SELECT page_id, html ILIKE '%<META%' AS has_meta FROM pages")
def contains(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", contains_ignoring_case(F.col("html"), "<META").alias("has_meta"))


@query("path_columns", """SELECT page_id,
  CASE WHEN page_id % 5 <> 0 THEN 'season ' || CAST(page_id % 3 AS VARCHAR) END AS season,
  CASE WHEN page_id % 5 <> 0 THEN CAST(page_id AS INTEGER) END AS gameweek,
  CAST(page_id AS INTEGER) AS file_period FROM pages""")
def path_columns(spark, sf_dir):
    key = F.col("page_id").cast("string")
    folder = F.when(F.col("page_id") % 5 == 0, F.lit("GWx")).otherwise(F.concat(F.lit("GW"), key))
    path = F.concat(F.lit("file:/data/season%20"), (F.col("page_id") % 3).cast("string"), F.lit("/By%20Gameweek/"), folder, F.lit("/x.csv"))
    name = F.concat(F.lit("GW"), key, F.lit("_predictions.CSV"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        path_part(path, PERIOD_PATH, 1).alias("season"),
        path_part(path, PERIOD_PATH, 2, "int").alias("gameweek"),
        period_from_name(name).alias("file_period"),
    )


@query("json_props", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS absent FROM events""")
def json_props(spark, sf_dir):
    props = F.from_json("props", "k int, stats struct<absent: int>").alias("p")
    return table(spark, sf_dir, "events").select("event_id", props).select("event_id", "p.k", "p.stats.absent")


@query("row_features", """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reached,
  round(coalesce(CASE WHEN l_returnflag = 'R' THEN l_tax END, 0) + coalesce(CASE WHEN l_linestatus = 'O' THEN l_discount END, 0), 6) AS total,
  'lineitem' AS origin FROM lineitem""")
def row_features(spark, sf_dir):
    tax = F.when(F.col("l_returnflag") == "R", F.col("l_tax"))
    discount = F.when(F.col("l_linestatus") == "O", F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", reached(F.col("l_quantity"), 25).alias("reached"),
        F.round(total_of(tax, discount), 6).alias("total"), F.lit("lineitem").alias("origin"),
    )


# --- pairs and joins ------------------------------------------------------------------------------


@query("pairs_long", ROLES_SQL + "SELECT * FROM fixtures")
def pairs_long(spark, sf_dir):
    return roles.fixtures(spark, sf_dir)


@query("pairs_by_match_id", ROLES_SQL + """SELECT season, gameweek, team_code, opp_code, is_home FROM fixtures""")
def pairs_by_match_id(spark, sf_dir):
    by_id = roles.matches(spark, sf_dir).withColumnRenamed("tournament", "match_id")
    return team_rows(keep_competition(by_id)).drop("team_elo", "opp_elo")


@query("blank_double_fixture", ROLES_SQL + """SELECT p.season, p.gameweek, p.team_code, count(f.team_code) AS fixtures
  FROM (SELECT DISTINCT season, gameweek, team_code FROM (SELECT season, gameweek, home_team AS team_code FROM schedule)) p
  LEFT JOIN fixtures f USING (season, gameweek, team_code) GROUP BY 1, 2, 3""")
def blank_double_fixture(spark, sf_dir):
    periods = F.explode(F.sequence(F.lit(1), F.lit(roles.PERIODS)))
    grid = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("team_code"), periods.alias("gameweek"))
    grid = grid.withColumn("season", roles.season_of(F.col("gameweek")))
    keys = ["season", "gameweek", "team_code"]
    per_team = roles.fixtures(spark, sf_dir).groupBy(*keys).agg(F.count(F.lit(1)).alias("fixtures"))
    return grid.join(per_team, keys, "left").select(*keys, F.coalesce("fixtures", F.lit(0)).alias("fixtures"))


@query("pairs_lineitem", """WITH league AS (SELECT * FROM lineitem WHERE l_returnflag IN ('R', 'N') AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL)
  SELECT l_orderkey, l_linenumber, l_partkey AS team_code, l_suppkey AS opp_code, 1 AS is_home, l_quantity AS team_elo, l_tax AS opp_elo FROM league
  UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, 0, l_tax, l_quantity FROM league""")
def pairs_lineitem(spark, sf_dir):
    """Every line is a match of a part at home and a supplier away; the flag tells the competition."""
    flag = F.col("l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("home_team"), F.col("l_suppkey").alias("away_team"),
        F.col("l_quantity").alias("home_team_elo"), F.col("l_tax").alias("away_team_elo"),
        F.when(flag == "R", F.lit("Premier")).when(flag == "N", F.lit("PREM tier 2")).when(flag == "A", F.lit("Cup")).alias("match_id"),
    )
    return team_rows(keep_competition(lines), keep=["l_orderkey", "l_linenumber"])


@query("fixtures_per_team_period", ROLES_SQL + """SELECT t.season, t.gameweek, t.team_code, t.entities, count(f.team_code) AS fixtures
  FROM (SELECT p.season, gameweek, team_code, count(*) AS entities FROM panel p LEFT JOIN members m ON m.season = p.season AND m.player_id = p.id GROUP BY 1, 2, 3) t
  LEFT JOIN fixtures f ON f.season = t.season AND f.gameweek = t.gameweek AND f.team_code = t.team_code GROUP BY 1, 2, 3, 4""")
def fixtures_per_team_period(spark, sf_dir):
    """How many entities of the panel meet none, one or several fixtures."""
    keys = ["season", "gameweek", "team_code"]
    rows = attach_team(roles.panel(spark, sf_dir), roles.members(spark, sf_dir))
    teams = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("entities"))
    counts = roles.fixtures(spark, sf_dir).groupBy(*keys).agg(F.count(F.lit(1)).alias("fixtures"))
    joined = left_lookup(teams, counts, keys)
    return joined.withColumn("fixtures", F.coalesce("fixtures", F.lit(0)))


@query("named_entities", ROLES_SQL + "SELECT season, player_id, player_name, team_short, position FROM names")
def named_entities(spark, sf_dir):
    return roles.names(spark, sf_dir)


# --- rolling features -----------------------------------------------------------------------------


@query("panel_rows", ROLES_SQL + "SELECT * FROM panel")
def panel_rows(spark, sf_dir):
    return roles.panel(spark, sf_dir)


@query("panel_form", ROLES_SQL + f"""SELECT season, id, gameweek, event_points, {sql_rounded(*LAST3)}
  FROM rolled WHERE pts_prev_gw IS NOT NULL AND event_points IS NOT NULL""")
def panel_form(spark, sf_dir):
    rows = rolling_features(with_form_inputs(roles.panel(spark, sf_dir)), FORM_LAST3)
    rows = cf.drop_missing(rows, ["pts_prev_gw", "event_points"])
    return rounded(rows.select("season", "id", "gameweek", "event_points", *LAST3), *LAST3)


@query("rolling_all", ROLES_SQL + f"SELECT season, id, gameweek, {sql_rounded(*ALL_FORM)} FROM rolled")
def rolling_all(spark, sf_dir):
    rows = rolling_features(with_form_inputs(roles.panel(spark, sf_dir)), FORM_ALL)
    return rounded(rows.select("season", "id", "gameweek", *ALL_FORM), *ALL_FORM)


@query("rolling_carried", ROLES_SQL + f"SELECT season, id, gameweek, {sql_rounded(*ALL_FORM)} FROM rolled")
def rolling_carried(spark, sf_dir):
    """The same features, rolled in steps from a carried state: all up to the cutoff, then period by period."""
    empty = versions.current(spark, scratch_path(spark, "carried"))
    panel = with_form_inputs(roles.panel(spark, sf_dir)).select(*state_columns(FORM_ALL, ("season", "id"), ("gameweek",)))
    landed = versions.commit(empty, {"panel": versions.Change(panel)})
    at = advance(landed, landed.table("panel").where(F.col("gameweek") <= roles.CUTOFF), FORM_ALL)
    for period in sorted({p["gameweek"] for p in landed.places("panel")}):
        if period > roles.CUTOFF:
            at = advance(at, landed.table("panel").where(F.col("gameweek") == period), FORM_ALL)
    return rounded(at.table("features").select("season", "id", "gameweek", *ALL_FORM), *ALL_FORM)


def dealt_by_entity(spark, sf_dir):
    """The panel and its members, stored dealt by season and entity."""
    panel = with_form_inputs(roles.panel(spark, sf_dir)).select(*state_columns(FORM_ALL, ("season", "id"), ("gameweek",)))
    members = roles.members(spark, sf_dir).select("season", F.col("player_id").alias("id"), "team_code")
    return (
        write_bucketed(panel, scratch_name("panel"), scratch_path(spark, "dealt-panel"), buckets=8),
        write_bucketed(members, scratch_name("members"), scratch_path(spark, "dealt-members"), order=(), buckets=8),
    )


@query("rolling_bucketed", ROLES_SQL + f"""SELECT r.season, id, gameweek, team_code, {sql_rounded(*ALL_FORM)} FROM rolled r
  LEFT JOIN members m ON m.season = r.season AND m.player_id = r.id""")
def rolling_bucketed(spark, sf_dir):
    """Teams and rolling features over tables that are dealt by season and entity: no row moves again."""
    panel, members = dealt_by_entity(spark, sf_dir)
    rows = left_lookup(rolling_features(panel, FORM_ALL), members, ["season", "id"])  # a join keeps no finer order than its keys
    return rounded(rows.select("season", "id", "gameweek", "team_code", *ALL_FORM), *ALL_FORM)


@query("clashing_lookup", ROLES_SQL + """SELECT p.season, gameweek, id, minutes, m.team_code AS minutes_right, position FROM panel p
  LEFT JOIN members m ON m.season = p.season AND m.player_id = p.id""")
def clashing_lookup(spark, sf_dir):
    """A lookup that has a column of the rows' own: it gets a suffix."""
    members = roles.members(spark, sf_dir).select("season", F.col("player_id").alias("id"), F.col("team_code").alias("minutes"), "position")
    return left_lookup(roles.panel(spark, sf_dir).select("season", "gameweek", "id", "minutes"), members.hint("merge"), ["season", "id"])


ORDER_SPECS = (
    Lag("o_totalprice", "prev"), Roll("o_totalprice", "avg", 3, "avg_last3"), Roll("o_totalprice", "avg", 5, "avg_last5"),
    Roll("urgent", "sum", 3, "urgent_last3"), Roll("urgent", "sum", 5, "urgent_last5"),
)
ORDER_COLUMNS = tuple(s.name for s in ORDER_SPECS)
ROLLING_ORDERS_SQL = f"""SELECT o_orderkey, o_custkey, {sql_rounded(*ORDER_COLUMNS)} FROM (
  SELECT o_orderkey, o_custkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev,
    avg(o_totalprice) OVER w3 AS avg_last3, avg(o_totalprice) OVER w5 AS avg_last5,
    sum(urgent) OVER w3 AS urgent_last3, sum(urgent) OVER w5 AS urgent_last5
  FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS urgent FROM orders)
  WINDOW w3 AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
    w5 AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))"""


def orders_rolled(spark, sf_dir, **options):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
    )
    rows = rolling_features(orders, ORDER_SPECS, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"], **options)
    return rounded(rows.select("o_orderkey", "o_custkey", *ORDER_COLUMNS), *ORDER_COLUMNS)


@query("rolling_orders", ROLLING_ORDERS_SQL)
def rolling_orders(spark, sf_dir):
    """A customer may hold any number of orders, so large ones are split."""
    return orders_rolled(spark, sf_dir, hot_rows=HOT_ROWS)


@query("rolling_orders_split", ROLLING_ORDERS_SQL)
def rolling_orders_split(spark, sf_dir):
    """The same with a low bound, so that many customers take the split route."""
    return orders_rolled(spark, sf_dir, hot_rows=10, block_rows=1000)


@query("rolling_global_compat", ROLES_SQL + f""", lagged AS (
  SELECT season, id, gameweek, lag(event_points) OVER k AS pts, lag(minutes) OVER k AS mins, lag(played60) OVER k AS played
  FROM form_inputs WINDOW k AS (PARTITION BY season, id ORDER BY gameweek))
  SELECT season, id, gameweek, {sql_rounded(*LAST3)} FROM (
    SELECT season, id, gameweek, pts AS pts_prev_gw, avg(pts) OVER w AS pts_avg_last3, avg(mins) OVER w AS mins_avg_last3,
      avg(played) OVER w AS played60_rate_last3
    FROM lagged WINDOW w AS (ORDER BY season, id, gameweek ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""")
def rolling_global_compat(spark, sf_dir):
    panel = with_form_inputs(roles.panel(spark, sf_dir))
    rows = rolling_features(panel, FORM_LAST3, mode="global", block_rows=1000)
    return rounded(rows.select("season", "id", "gameweek", *LAST3), *LAST3)


# --- model table ----------------------------------------------------------------------------------


@query("model_table", ROLES_SQL + f"""SELECT season, gameweek, id, {sql_rounded(*ALL_FORM)}, {", ".join(EXTENDED_BASIC[4:])}, minutes, event_points
  FROM model""")
def full_model_table(spark, sf_dir):
    rows = roles.form_model(spark, sf_dir, FORM_ALL, columns=WIDE_MODEL)
    return rounded(rows, *ALL_FORM)


@query("model_table_fixtures_first", ROLES_SQL + f""", fanned AS (
  SELECT p.*, m.team_code, f.opp_code, f.is_home, f.team_elo, f.opp_elo,
    CASE WHEN f.is_home = 1 THEN t.strength_defence_away WHEN f.is_home = 0 THEN t.strength_defence_home END AS opp_def_strength
  FROM form_inputs p LEFT JOIN members m ON m.season = p.season AND m.player_id = p.id
  LEFT JOIN fixtures f ON f.season = p.season AND f.gameweek = p.gameweek AND f.team_code = m.team_code
  LEFT JOIN teams t ON t.season = p.season AND t.team_code = f.opp_code),
  refanned AS (
  SELECT *, lag(event_points) OVER (PARTITION BY season, id ORDER BY gameweek, opp_code NULLS FIRST, is_home NULLS FIRST) AS pts_prev_gw,
    avg(event_points) OVER w AS pts_avg_last3, avg(minutes) OVER w AS mins_avg_last3, avg(played60) OVER w AS played60_rate_last3
  FROM fanned WINDOW w AS (PARTITION BY season, id ORDER BY gameweek, opp_code NULLS FIRST, is_home NULLS FIRST ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
  SELECT season, gameweek, id, opp_code, {sql_rounded(*LAST3)} FROM refanned
  WHERE pts_prev_gw IS NOT NULL AND opp_def_strength IS NOT NULL AND event_points IS NOT NULL""")
def model_table_fixtures_first(spark, sf_dir):
    rows = roles.form_model(spark, sf_dir, fixtures_first=True)
    return rounded(rows.select("season", "gameweek", "id", "opp_code", *LAST3), *LAST3)


@query("engineered_columns", ROLES_SQL + """SELECT season, gameweek, id, opp_code, now_cost, selected_by_percent, form,
  round(team_elo - opp_elo, 6) AS elo_diff, round(form * is_home, 6) AS form_x_home FROM model""")
def engineered_columns(spark, sf_dir):
    table_ = model_table(roles.panel(spark, sf_dir), *roles.dimensions(spark, sf_dir), columns=MODEL_COLUMNS)
    rows = engineered(table_).select(
        "season", "gameweek", "id", "opp_code", "now_cost", "selected_by_percent", "form", "elo_diff", "form_x_home"
    )
    return rounded(rows, "elo_diff", "form_x_home")


@query("time_split_counts", ROLES_SQL + """SELECT CASE WHEN gameweek <= 25 THEN 'train' ELSE 'test' END AS split,
  count(*) AS "rows", count(DISTINCT gameweek) AS periods FROM model WHERE season = '2024-B' GROUP BY 1""")
def time_split_counts(spark, sf_dir):
    train, test = time_split(one_season(roles.form_model(spark, sf_dir), roles.CURRENT), roles.CUTOFF)
    sides = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return sides.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("gameweek").alias("periods"))


# --- snapshots ------------------------------------------------------------------------------------


@query("latest_rows", ROLES_SQL + """SELECT season, id, gameweek, event_points, minutes, now_cost FROM (
  SELECT *, row_number() OVER (PARTITION BY season, id ORDER BY gameweek DESC) AS rn
  FROM (SELECT * REPLACE (TRY_CAST(now_cost AS DOUBLE) AS now_cost) FROM panel)) WHERE rn = 1""")
def newest_rows(spark, sf_dir):
    rows = latest_rows(roles.panel(spark, sf_dir), ["season", "id"], ["gameweek"]).drop("_rank")
    return cf.lenient(rows, {"now_cost": "double"}).select("season", "id", "gameweek", "event_points", "minutes", "now_cost")


CURRENT_FORM_SQL = """current_form AS (
  SELECT season, id, max(event_points) FILTER (WHERE rn = 1) AS pts_prev_gw, avg(event_points) AS pts_avg_last3,
    avg(minutes) AS mins_avg_last3, avg(CASE WHEN minutes >= 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS played60_rate_last3,
    max(TRY_CAST(now_cost AS DOUBLE)) FILTER (WHERE rn = 1) AS now_cost,
    max(TRY_CAST(replace(selected_by_percent, '%', '') AS DOUBLE)) FILTER (WHERE rn = 1) AS selected_by_percent,
    max(TRY_CAST(form AS DOUBLE)) FILTER (WHERE rn = 1) AS form
  FROM (SELECT *, row_number() OVER (PARTITION BY season, id ORDER BY gameweek DESC) AS rn FROM panel) WHERE rn <= 3 GROUP BY 1, 2)"""


@query("current_form", ROLES_SQL + f", {CURRENT_FORM_SQL} SELECT season, id, {sql_rounded(*LAST3)}, now_cost, selected_by_percent, form FROM current_form")
def tail_form(spark, sf_dir):
    rows = cf.percent_columns(current_form(roles.panel(spark, sf_dir)), ["now_cost", "selected_by_percent", "form"])
    return rounded(rows, *LAST3)


@query("last_period", ROLES_SQL + """SELECT season, max(gameweek) AS last_gw, max(gameweek) + 1 AS next_gw FROM model
  WHERE season = (SELECT max(season) FROM model) GROUP BY 1""")
def newest_period(spark, sf_dir):
    return last_period(roles.form_model(spark, sf_dir))


NEXT_SQL = f""", {CURRENT_FORM_SQL}, next_rows AS (
  SELECT c.*, CAST(31 AS INTEGER) AS gameweek, f.is_home, f.team_elo, f.opp_elo,
    CASE WHEN f.is_home = 1 THEN t.strength_defence_away ELSE t.strength_defence_home END AS opp_def_strength, m.team_code, f.opp_code
  FROM current_form c JOIN members m ON m.season = c.season AND m.player_id = c.id
  JOIN fixtures f ON f.season = c.season AND f.gameweek = (SELECT max(gameweek) + 1 FROM panel) AND f.team_code = m.team_code
  LEFT JOIN teams t ON t.season = c.season AND t.team_code = f.opp_code
  WHERE c.season = (SELECT max(season) FROM panel))
"""


@query("next_period_rows", ROLES_SQL + NEXT_SQL + f"""SELECT season, gameweek, id, {sql_rounded(*LAST3)}, now_cost, selected_by_percent, form,
  is_home, team_elo, opp_elo, opp_def_strength, team_code, opp_code FROM next_rows""")
def upcoming_rows(spark, sf_dir):
    rows = next_period_rows(roles.panel(spark, sf_dir), *roles.dimensions(spark, sf_dir))
    return rounded(rows.select("season", "gameweek", "id", *EXTENDED_BASIC), *LAST3)


@query("named_latest_rows", ROLES_SQL + """SELECT l.season, id, gameweek, player_name, team_short, position FROM (
  SELECT season, id, max(gameweek) AS gameweek FROM panel GROUP BY 1, 2) l
  LEFT JOIN names n ON n.season = l.season AND n.player_id = l.id""")
def named_latest_rows(spark, sf_dir):
    rows = latest_rows(roles.panel(spark, sf_dir).select("season", "id", "gameweek"), ["season", "id"], ["gameweek"])
    return attach_names(rows.drop("_rank"), roles.names(spark, sf_dir))
