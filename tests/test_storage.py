"""Dealt tables, ordered exports and kept keys."""

import unicodedata

from pyspark.sql import functions as F

from panelcast.operators.enrich import left_lookup
from panelcast.operators.keys import extended, known_keys, unseen_names, with_known_keys
from panelcast.operators.rolling import FORM_ALL, rolling_features
from panelcast.session import release
from panelcast.sources import sink, versions
from panelcast.sources.bucketed import one_file_each
from panelcast.workload.feature_queries import dealt_by_entity

SF_DIR = "/root/testdata/sf0.001"


def test_dealt_tables_need_no_exchange(spark):
    panel, members = dealt_by_entity(spark, SF_DIR)
    ordering, broadcast = "spark.sql.legacy.bucketedTableScan.outputOrdering", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, -1)  # as if members were many
    try:
        for ordered in ("false", "true"):
            spark.conf.set(ordering, ordered)
            rows = left_lookup(rolling_features(panel, FORM_ALL), members, ["season", "id"])
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("Window [") == 1
            assert ("Sort [" in plan) == (ordered == "false")
        assert rows.count() == panel.count()
        names = [t.name for t in spark.catalog.listTables()]
        assert len(names) == 2 and all(one_file_each(spark, n, 8) for n in names)
    finally:
        spark.conf.unset(ordering)
        spark.conf.set(broadcast, before)
    release(spark)
    assert not spark.catalog.listTables()


def test_ordered_export(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 100).cast("double").alias("points"), F.lit('a "b", c').alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or few rows become one file
    try:
        sink.write_ordered(rows, str(tmp_path / "e"), [F.desc("points"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(sink.ordered_parts(spark, str(tmp_path / "e")).collect(), key=lambda r: r.part)
    assert len(parts) > 1 and parts[0].first_rank == 1 and parts[-1].last_rank == 5000
    assert all(a.last_rank + 1 == b.first_rank for a, b in zip(parts, parts[1:]))
    wanted = sorted(((-r.points, r.id) for r in rows.collect()))
    in_files = [line.split(",")[:2] for p in parts for line in (tmp_path / "e" / "rows" / p.part).read_text().splitlines()[1:]]
    assert [(int(rank), int(i)) for rank, i in in_files] == [(n, i) for n, (_, i) in enumerate(wanted, 1)]
    schema = "id long, points double, name string"
    some = sink.read_ranks(spark, str(tmp_path / "e"), schema, 100, 120)
    assert sorted((r["rank"], r.id, r.name) for r in some.collect()) == [(n, wanted[n - 1][1], 'a "b", c') for n in range(100, 121)]
    assert len(some.inputFiles()) < len(parts)
    assert sink.read_ranks(spark, str(tmp_path / "e"), schema, 6000, 7000).count() == 0
    sink.write_ordered(rows.limit(0), str(tmp_path / "none"), ["id"])
    assert sink.ordered_parts(spark, str(tmp_path / "none")).count() == 0


def test_done_periods_come_from_the_output(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.done_periods(spark, path).count() == 0
    rows = spark.createDataFrame([("a/b c", 1, 5), ("a/b c", 2, 6), ("d", 1, 7)], "season string, gameweek int, id long")
    sink.write_periods(rows, path)
    assert {(r.season, int(r.gameweek)) for r in sink.done_periods(spark, path).collect()} == {("a/b c", 1), ("a/b c", 2), ("d", 1)}


def plain_key(text):
    folded = unicodedata.normalize("NFKD", text.strip().lower())
    return "".join(c for c in folded if not unicodedata.combining(c))


def test_only_unseen_names_are_folded(spark, tmp_path):
    one = spark.createDataFrame([(" Ünal ", "Ça"), ("Bob", "Ça"), (None, "x")] * 50, "player_name string, team_short string")
    two = spark.createDataFrame([("Bob", "Éz"), ("ñandú", None)], "player_name string, team_short string")
    columns = ("player_name", "team_short")
    first = extended(versions.current(spark, str(tmp_path)), [one], columns)
    assert known_keys(first).count() == 4 == first.rows("keys")
    assert {r.name for r in unseen_names(first, [one, two], columns).collect()} == {"ñandú", "Éz"}
    second = extended(first, [one, two], columns)
    assert set(first.folders("keys").items()) < set(second.folders("keys").items()) and second.rows("keys") == 6
    assert unseen_names(second, [one, two], columns).isEmpty()
    for r in known_keys(second).collect():
        assert r.key == plain_key(r.name)
    keyed = with_known_keys(two, known_keys(second), columns)
    assert "Arrow" not in keyed._jdf.queryExecution().executedPlan().toString()
    assert {(r.player_name, r._key_player_name, r._key_team_short) for r in keyed.collect()} == {("Bob", "bob", "ez"), ("ñandú", "nandu", None)}
