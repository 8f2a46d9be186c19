import json
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators.conform import MissingColumns, conform
from panelcast.operators.enrich import entity_names
from panelcast.operators.reconcile import prepare_actuals, reconcile
from panelcast.plans.models import Settings, forecast_next_period
from panelcast.sources import feeds, sink, tree


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def root(tmp_path):
    stats = "player_gameweek_stats.csv"
    put(tmp_path / "2024-2025/By Gameweek/GW1" / stats, "id,event_points,minutes,gameweek\n1,5,90,99\n2,NA,60,99\n")
    put(tmp_path / "2024-2025/By Gameweek/GW2" / stats, "minutes,id,event_points,form\n45,1,2,0.5\n")
    put(tmp_path / "2025-2026/By Gameweek/GW10" / stats, "\ufeffid,event_points,minutes\n7,1,10\n")
    put(tmp_path / "2025-2026/By Gameweek/GW11" / stats, "")
    put(tmp_path / "2025-2026/By Gameweek/GWx" / stats, "id,event_points,minutes\n8,1,10\n")
    put(tmp_path / "2025-2026/By Gameweek/other" / stats, "id,event_points,minutes\n8,1,10\n")
    put(tmp_path / "2023-2024/Elsewhere/GW1" / stats, "id,event_points,minutes\n9,1,10\n")
    put(tmp_path / "2025-2026/By Gameweek/GW12/fixtures.csv", "home_team,away_team,home_team_elo,away_team_elo,match_id\n1,2,3,4,a-Prem-1\n5,6,7,8,cup\n")
    put(tmp_path / "2025-2026/By Gameweek/GW13/fixtures.csv", "home_team,away_team,home_team_elo,away_team_elo,tournament\n1,2,3,4,prem\n5,6,7,8,\n")
    put(tmp_path / "2024-2025/players.csv", "player_id,team_code,position,web_name\n1,10,Forward,Šeško\n")
    put(tmp_path / "2025-2026/players.csv", "web_name,team_code,player_id\nnan,20,7\n")
    put(tmp_path / "2023-2024/players.csv", "player_id,position\n1,Forward\n")
    put(tmp_path / "2024-2025/teams.csv", "code,short_name,strength_defence_home,strength_defence_away,elo\n10,TEN,1100,bad,1\n,X,1,1,1\n")
    put(tmp_path / "readme.txt", "no season")
    return tmp_path


def test_panel_scan(spark, root):
    rows = tree.scan_panel(spark, str(root))
    spec = {"id": "long", "event_points": "double", "minutes": "double", "form": "double"}
    got = conform(tree.with_int_period(rows), spec).select("season", "gameweek", *spec).orderBy("season", "gameweek", "id")
    assert [tuple(r) for r in got.collect()] == [
        ("2024-2025", 1, 1, 5.0, 90.0, None), ("2024-2025", 1, 2, None, 60.0, None),
        ("2024-2025", 2, 1, 2.0, 45.0, 0.5), ("2025-2026", 10, 7, 1.0, 10.0, None),
    ]


def test_dimension_scans(spark, root):
    members = tree.scan_members(spark, str(root))
    assert sorted(map(tuple, members.collect())) == [("2024-2025", 1, 10, "Forward", "Šeško"), ("2025-2026", 7, 20, None, None)]
    assert tree.one_season(members, "2024-2025").count() == 1
    assert list(map(tuple, tree.scan_teams(spark, str(root)).collect())) == [("2024-2025", 10, "TEN", 1100.0, None)]


def test_competition_column_is_chosen_per_header(spark, root):
    got = tree.load_fixtures(spark, str(root)).orderBy("gameweek", "team_code").collect()
    assert [(r["season"], r["gameweek"], r["team_code"], r["opp_code"], r["is_home"]) for r in got] == [
        ("2025-2026", 12, 1, 2, 1), ("2025-2026", 12, 2, 1, 0), ("2025-2026", 13, 1, 2, 1), ("2025-2026", 13, 2, 1, 0)]


def test_tree_to_forecast(spark, tmp_path):
    """Files on disk to a ranked forecast, with headers that differ between periods."""
    random.seed(2)
    for gw in range(1, 8):
        folder = tmp_path / f"2025-2026/By Gameweek/GW{gw}"
        if gw < 7:
            lines = [f"{i},{random.randint(0, 9)},{random.choice([30, 90])},4.{i % 9},{i}%,{i % 4}.5" for i in range(24)]
            head = "id,event_points,minutes,now_cost,selected_by_percent,form"
            if gw % 2:
                head, lines = "minutes,id,event_points,form,selected_by_percent,now_cost,expected_goals,expected_assists", [
                    ",".join([line.split(",")[k] for k in (2, 0, 1, 5, 4, 3)]) + ",0.1,NA" for line in lines]
            put(folder / "player_gameweek_stats.csv", "\n".join([head, *lines]) + "\n")
        key = "tournament" if gw % 3 else "match_id"
        put(folder / "fixtures.csv", f"home_team,away_team,home_team_elo,away_team_elo,{key}\n"
                                     "1,2,1500,1600,Premier\n3,1,1400,1500,Cup\n" + ("3,4,1400,1450,prem-x\n" if gw < 7 else ""))
    put(tmp_path / "2025-2026/players.csv", "player_id,team_code,position,web_name\n" + "".join(
        f"{i},{i % 4 + 1},{'Forward' if i % 2 else 'Defender'},Nämé{i}\n" for i in range(24)))
    put(tmp_path / "2025-2026/teams.csv", "code,short_name,strength_defence_home,strength_defence_away\n" + "".join(
        f"{t},T{t},{1000 + t},{1100 + t}\n" for t in range(1, 5)))
    root = str(tmp_path)
    members, teams = tree.scan_members(spark, root), tree.scan_teams(spark, root)
    settings = Settings(scoring_trees=5, forest_depth=4, max_bins=16)
    forecast = forecast_next_period(
        tree.load_panel(spark, root), members, tree.load_fixtures(spark, root), teams, entity_names(members, teams), settings=settings)
    rows = forecast.export().collect()
    assert len(rows) == 12 and {(r["gameweek"], r["team_short"]) for r in rows} == {(7, "T1"), (7, "T2")}
    sink.write_csv(forecast.export().coalesce(1), f"{root}/gw7_predictions.csv")
    saved = tree.read_table(spark, f"{root}/gw7_predictions.csv", {"gameweek": "int", "predicted_points": "double"})
    assert [tuple(r) for r in saved.collect()] == [tuple(r) for r in rows]
    actuals = tree.load_panel(spark, root).where("gameweek = 6").withColumn("gameweek", F.lit(7))
    errors = reconcile(saved, prepare_actuals(actuals), entity_names(members, teams)).collect()
    assert len(errors) == 12 and all(r["abs_error"] == abs(r["predicted_points"] - r["event_points"]) for r in errors)


def test_empty_tree_stops(spark, tmp_path):
    with pytest.raises(tree.EmptySource):
        tree.scan_panel(spark, str(tmp_path))
    put(tmp_path / "s/players.csv", "x,y\n1,2\n")
    with pytest.raises(tree.EmptySource):
        tree.scan_members(spark, str(tmp_path))


def test_named_periods(spark, tmp_path):
    put(tmp_path / "gw2_predictions.csv", "gameweek,player_name,predicted_points\n2,Šeško,1.5\n")
    put(tmp_path / "GW10_predictions.csv", "player_name,gameweek,predicted_points\nBo,10,2\n")
    spec = {"gameweek": "int", "predicted_points": "double"}
    rows = tree.scan_named_periods(spark, f"{tmp_path}/*.csv", "_predictions.csv", spec)
    got = rows.select("file_period", "gameweek", "player_name", "predicted_points").orderBy("file_period").collect()
    assert [tuple(r) for r in got] == [(2, 2, "Šeško", 1.5), (10, 10, "Bo", 2.0)]
    put(tmp_path / "notes.csv", "a\n1\n")
    with pytest.raises(ValueError, match="no period"):
        tree.scan_named_periods(spark, f"{tmp_path}/*.csv", "_predictions.csv", spec)
    assert tree.scan_named_periods(spark, f"{tmp_path}/*.csv", "_predictions.csv", spec, skip_others=True).count() == 2
    put(tmp_path / "gw3_predictions.csv", "gameweek,player_name\n3,Al\n")
    with pytest.raises(MissingColumns):
        tree.scan_named_periods(spark, f"{tmp_path}/gw*.csv", "_predictions.csv", spec)
    complete = tree.scan_named_periods(spark, f"{tmp_path}/[gG][wW]*.csv", "_predictions.csv", spec, skip_incomplete=True)
    assert sorted(r["file_period"] for r in complete.collect()) == [2, 10]


def test_read_table(spark, tmp_path):
    put(tmp_path / "t.csv", "id,form\n1,0.5\n2,n/a\n")
    assert [tuple(r) for r in tree.read_table(spark, f"{tmp_path}/t.csv", {"id": "long", "form": "double"}).collect()] == [(1, 0.5), (2, None)]


def test_csv_text_survives(spark, tmp_path):
    texts = ['Big "Al" Bo', "a,b", " padded ", "back\\slash", "Šeško"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, name string").coalesce(1)
    sink.write_csv(rows, f"{tmp_path}/t")
    got = tree.read_table(spark, f"{tmp_path}/t", {"id": "int"}).orderBy("id").collect()
    assert [r["name"] for r in got] == texts
    put(tmp_path / "s/players.csv", 'player_id,team_code,web_name\n1,2,"Big ""Al"" Bo"\n')
    assert tree.scan_members(spark, str(tmp_path)).first()["web_name"] == 'Big "Al" Bo'


def test_feeds(spark, tmp_path):
    put(tmp_path / "snapshot.json", json.dumps({
        "elements": [{"id": 1, "web_name": "Šeško", "team": 5}, {"id": 2, "web_name": "Bo", "team": 6}, {"id": 4, "web_name": "Cy"}],
        "teams": [{"id": 5, "short_name": "MUN"}]}, indent=2))
    put(tmp_path / "live.json", json.dumps({"elements": [
        {"id": 1, "stats": {"total_points": 3}}, {"id": 2, "stats": {}}, {"id": 3, "stats": {"total_points": 1}},
        {"id": 4, "stats": {"total_points": 0}}]}))
    put(tmp_path / "empty.json", "{}")
    snapshot = feeds.read_documents(spark, f"{tmp_path}/snapshot.json", feeds.SNAPSHOT_SCHEMA)
    live = feeds.read_documents(spark, f"{tmp_path}/live.json", feeds.LIVE_SCHEMA).withColumn("gameweek", F.lit(9))
    table = feeds.points_table(feeds.live_points(live, "gameweek"), feeds.snapshot_entities(snapshot), feeds.snapshot_teams(snapshot))
    assert [tuple(r) for r in table.orderBy("player_id").collect()] == [
        (1, "Šeško", "MUN", 9, 3.0), (2, "Bo", None, 9, None), (3, None, None, 9, 1.0), (4, "Cy", None, 9, 0.0)]
    assert feeds.live_points(feeds.read_documents(spark, f"{tmp_path}/empty.json", feeds.LIVE_SCHEMA)).count() == 0
    assert tuple(feeds.snapshot_sizes(snapshot).first()) == (3, 1)


def test_period_sink_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.range(100).select(F.lit("s").alias("season"), (F.col("id") % 5).cast("int").alias("gameweek"), "id")
    assert sink.write_periods(data, path) == 100
    assert sink.write_periods(data.where("gameweek = 2").limit(3), path) == 3
    got = spark.read.parquet(path).groupBy("gameweek").count().orderBy("gameweek").collect()
    assert [r["count"] for r in got] == [20, 20, 3, 20, 20]
    sink.write_csv(data.limit(2), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["season", "gameweek", "id"]


def test_names_of_folders_are_decoded_and_no_file_is_lost(spark, tmp_path):
    for season in ("Saison é#24", "a+b", "100%", "x y"):
        folder = tmp_path / season / "By Gameweek" / "GW3"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text("id,v\n1,2\n")
        empty = tmp_path / season / "By Gameweek" / "GW4"
        empty.mkdir()
        (empty / "f.csv").write_text("")
    pattern = f"{tmp_path}/*/By Gameweek/GW*/f.csv"
    rows = tree.scan_tree(spark, pattern, required=["id"]).collect()
    assert sorted((r.season, r.gameweek, r.id) for r in rows) == [(s, 3, "1") for s in ("100%", "Saison é#24", "a+b", "x y")]
    outcomes = [r.outcome for r in tree.scan_report(spark, pattern, required=["id", "w"]).collect()]
    assert sorted(outcomes) == ["empty"] * 4 + ["lacks w"] * 4


def test_headers_read_a_buffer_of_each_file_and_run_no_job(spark, tmp_path):
    """What is read does not grow with the files."""
    paths = []
    for i in range(40):
        path = tmp_path / f"{i}.csv"
        path.write_text(f"id,c{i % 2}\n" + f"{i},{'x' * 90}\n" * (100_000 if i < 3 else 2))
        paths.append(f"file:{path}")
    files, tracker = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem, spark.sparkContext.statusTracker()

    def read() -> int:
        return sum(s.getBytesRead() for s in files.getAllStatistics())

    before = read()
    spark.sparkContext.setJobGroup("headers", "")
    groups = tree.headers_of(spark, paths)
    jobs = tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in groups.items()} == {("id", "c0"): 20, ("id", "c1"): 20}
    assert not jobs and 0 < read() - before < 40 * 70_000
    assert sum(p.stat().st_size for p in tmp_path.iterdir()) > 25_000_000
    blank = tmp_path / "blank.csv"
    blank.write_text("\nid\n")
    assert tree.headers_of(spark, [f"file:{blank}"]) == {(): [f"file:{blank}"]}
    assert tree.headers_of(spark, []) == {}
