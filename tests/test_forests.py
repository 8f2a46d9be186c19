import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.plans import forests


def plain_tree(bins, y, w, depth, least, row):
    """Where one row ends: every split tried by itself."""
    best, base = None, (w * y).sum() ** 2 / w.sum()
    if depth and y.max() > y.min():
        for f in range(len(bins)):
            for cut in np.unique(bins[f])[:-1]:
                left = bins[f] <= cut
                if min(w[left].sum(), w[~left].sum()) >= least:
                    gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left))
                    if gain > (best[0] if best else base) + 1e-9:
                        best = gain, f, cut
    if best is None:
        return (w * y).sum() / w.sum()
    side = (bins[best[1]] <= best[2]) == (row[best[1]] <= best[2])
    return plain_tree(bins[:, side], y[side], w[side], depth - 1, least, row)


@pytest.mark.parametrize(("depth", "least"), [(30, 1), (3, 1), (30, 4), (0, 1)])
def test_levels_grow_the_tree_of_plain_recursion(depth, least):
    rng = np.random.default_rng(depth + least)
    for n in (1, 2, 60, 300):
        bins, y = rng.integers(0, 7, (3, n)).astype(np.uint8), rng.normal(size=n)
        w, asked = rng.integers(1, 4, n).astype(float), rng.integers(0, 7, (3, 40)).astype(np.uint8)
        got = forests.grown(bins, y, w, depth, least, asked)
        np.testing.assert_allclose(got, [plain_tree(bins, y, w, depth, least, a) for a in asked.T], atol=1e-9)


@pytest.mark.parametrize("dense", [1, 20, 10**9])
def test_sums_of_bins_and_ordered_rows_split_alike(dense):
    rng = np.random.default_rng(5)
    bins, w, asked = rng.integers(0, 7, (3, 300)).astype(np.uint8), rng.integers(1, 4, 300).astype(float), rng.integers(0, 7, (3, 20)).astype(np.uint8)
    y = np.round(rng.normal(size=300), 1)
    for f in (1, 3):
        got = forests.grown(bins[:f], y, w, 30, 1, asked[:f], dense=dense)
        np.testing.assert_allclose(got, [plain_tree(bins[:f], y, w, 30, 1, a) for a in asked[:f].T], atol=1e-9)


def test_nodes_without_a_row_to_score_are_not_split(monkeypatch):
    rng, nodes = np.random.default_rng(6), []
    search = forests.dense_splits
    monkeypatch.setattr(forests, "dense_splits", lambda bins, order, starts, *rest: nodes.append(len(starts)) or search(bins, order, starts, *rest))
    bins, y = rng.integers(0, 60, (3, 2000)).astype(np.uint8), rng.normal(size=2000)
    forests.grown(bins, y, np.ones(2000), 30, 1, bins[:, :1], dense=0)
    assert len(nodes) > 5 and max(nodes) == 1


def test_rows_in_many_partitions_are_drawn_in_few_tasks(spark):
    df = league(spark, 300).repartition(40)
    forest = forests.deep_forest(df, ["a", "b", "c"], "y", 3, 30, 32, 1, 7)
    assert forest.different == 300 and forest.dealt.rdd.getNumPartitions() == 1
    assert scores(forest, df) == scores(forests.deep_forest(df.coalesce(1), ["a", "b", "c"], "y", 3, 30, 32, 1, 7), df)


def test_values_of_all_features_are_read_in_one_job(spark):
    df = spark.createDataFrame([(float(i % 3), float(i % 4), float(i % 5), float(i)) for i in range(200)], "a double, b double, c double, d double")
    spark.sparkContext.setJobGroup("limits", "")
    try:
        found = forests.thresholds(df, ["a", "b", "c", "d"], 8)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [list(t) for t in found[:3]] == [[0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 4]] and len(found[3]) == 7
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("limits")) <= 4  # one of two stages, or one each, for quantiles and for values


def league(spark, n=1500, copies=1):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(n, 2)), 3)
    rows = [(float(a), float(b), i % 2, float(3 * a + b * b + i % 2 + e)) for i, ((a, b), e) in enumerate(zip(x, rng.normal(0, 0.1, n)))]
    return spark.createDataFrame(rows * copies, "a double, b double, c int, y double")


def scores(forest, df):
    return {(r.a, r.b, r.c): r.predicted_points for r in forest.transform(df).collect()}


def test_nodes_split_over_all_rows_end_in_the_same_trees(spark):
    df = league(spark)
    asked = df.limit(50)
    whole = scores(forests.deep_forest(df, ["a", "b", "c"], "y", 5, 30, 32, 1, 7), asked)
    split = forests.deep_forest(df, ["a", "b", "c"], "y", 5, 30, 32, 1, 7, rows_in_task=100)
    assert all(len(top.feature) > 10 for top in split.tops())
    parts = scores(split, asked)
    assert whole.keys() == parts.keys() and all(abs(whole[k] - parts[k]) < 1e-9 for k in whole)
    shallow = [scores(forests.deep_forest(df, ["a", "b", "c"], "y", 5, 2, 32, 1, 7, n), asked) for n in (100, 10_000)]
    assert all(abs(shallow[0][k] - shallow[1][k]) < 1e-9 for k in whole)


def test_forest_learns_and_rows_stay(spark):
    df = league(spark)
    forest = forests.deep_forest(df, ["a", "b", "c"], "y", 20, 30, 64, 1, 7)
    asked = df.limit(100).unionByName(df.limit(3))
    rows = forest.transform(asked).collect()
    assert len(rows) == 103 and rows[0].asDict().keys() == {"a", "b", "c", "y", "predicted_points"}
    assert np.mean([abs(r.predicted_points - r.y) for r in rows]) < 0.3
    again = scores(forests.deep_forest(df.repartition(7), ["a", "b", "c"], "y", 20, 30, 64, 1, 7), asked)
    assert again == {(r.a, r.b, r.c): r.predicted_points for r in rows}


def test_every_copy_is_drawn_on_its_own(spark):
    key = np.arange(20_000, dtype=np.int64) * 7919
    one = forests.drawn(key, np.ones(len(key), np.int64), 3, 42)
    assert abs(one.mean() - 1) < 0.03 and abs(one.var() - 1) < 0.05
    three = forests.drawn(key, np.full(len(key), 3), 3, 42)
    assert abs(three.mean() - 3) < 0.05 and abs(three.var() - 3) < 0.1
    other = forests.drawn(key, np.ones(len(key), np.int64), 4, 42)
    assert abs(np.corrcoef(one, other)[0, 1]) < 0.03
    kept = forests.deep_forest(league(spark, 50, copies=4), ["a", "b", "c"], "y", 2, 5, 8, 1, 7).kept
    assert kept.agg(F.sum("copies")).first()[0] == 200 and kept.count() == 50


def test_few_values_keep_bins_of_their_own(spark):
    df = spark.createDataFrame([(float(i % 1000 == 0) * (1 + i // 1000), float(i)) for i in range(5000)], "a double, b double")
    few, many = forests.thresholds(df, ["a", "b"], 16)
    assert list(few) == [0, 1, 2, 3, 4, 5] and len(many) == 15 and abs(many[7] - 2500) < 30


def test_large_node_without_a_split_keeps_its_mean(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0, float(i % 9)) for i in range(900)] + [(1.0, 2.0, 0, 50.0 + i) for i in range(90)], "a double, b double, c int, y double")
    forest = forests.deep_forest(df, ["a", "b", "c"], "y", 30, 30, 8, 1, 7, rows_in_task=2)
    got = scores(forest, df)
    assert abs(got[(1.0, 1.0, 0)] - 4) < 0.2 and abs(got[(1.0, 2.0, 0)] - 94.5) < 2
