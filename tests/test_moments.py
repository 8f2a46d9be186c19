import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelcast.plans import models, moments
from panelcast.plans.model_table import FEATURE_SETS, TARGET
from panelcast.workload.model_queries import current_table

SF = "/root/testdata/sf0.001"


def plain(x, y, alpha):
    mean = x.mean(axis=0)
    beta = np.linalg.solve((x - mean).T @ (x - mean) + alpha * np.eye(x.shape[1]), (x - mean).T @ (y - y.mean()))
    return beta, y.mean() - mean @ beta


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(900):
        a, b, c = rng.normal(1500, 80), rng.normal(), float(rng.integers(0, 2))
        y = 0.01 * a + 2 * b - c + rng.normal()
        rows.append((int(rng.choice([3, 4, 7, 8, 9])), *(None if rng.random() < 0.05 else float(v) for v in (a, b, c, y))))
    return spark.createDataFrame(rows, "gameweek int, a double, b double, c double, event_points double").persist()


def test_every_cutoff_equals_its_own_fit(spark, table):
    sets = {"all": ("a", "b", "c"), "two": ("b", "a")}
    found = {(r.feature_set, r.cutoff): r for r in moments.rolling_origin(table, sets).collect()}
    assert set(found) == {(s, p) for s in sets for p in (3, 4, 7, 8)}
    for (name, cutoff), r in found.items():
        rows = np.array(table.na.drop(subset=[*sets[name], TARGET]).select("gameweek", *sets[name], TARGET).collect(), float)
        early = rows[:, 0] <= cutoff
        beta, intercept = plain(rows[early, 1:-1], rows[early, -1], 1.0)
        residual = rows[:, -1] - rows[:, 1:-1] @ beta - intercept
        after = rows[:, 0] == r.next_period
        assert np.allclose(r.coefficients, beta, atol=1e-8) and abs(r.intercept - intercept) < 1e-5
        assert (r.rows, r.next_rows, r.test_rows) == (early.sum(), after.sum(), (~early).sum())
        for got, mask in ((r.train_rmse, early), (r.next_rmse, after), (r.test_rmse, ~early)):
            assert abs(got - np.sqrt((residual[mask] ** 2).mean())) < 1e-6
    errors = {(r.feature_set, r.cutoff): r for r in moments.origin_errors(table, moments.rolling_origin(table, sets), sets).collect()}
    assert errors.keys() == found.keys()
    assert all(errors[k].rows == found[k].next_rows and errors[k].mae <= found[k].next_rmse for k in found)


def test_published_feature_sets_agree_with_the_library_fit(spark):
    table = current_table(spark, SF)
    for name, found in moments.moments_of(table).items():
        for cutoff in (20, 25):
            train = models.aligned(table.where(F.col("gameweek") <= cutoff), FEATURE_SETS[name])
            train = VectorAssembler(inputCols=list(FEATURE_SETS[name]), outputCol="features").transform(train)
            fitted = models.ridge(train, TARGET, models.Settings()).fit(train)
            solution = found.ridge(cutoff)
            assert solution.rows == train.count()
            assert np.allclose(solution.coefficients, fitted.coefficients.toArray(), rtol=1e-5, atol=1e-6)
            assert abs(solution.intercept - fitted.intercept) < 1e-4


def test_subsets_need_no_second_pass(table):
    whole = moments.moments_of(table.na.drop(), {"all": ("a", "b", "c")})["all"]
    one = moments.moments_of(table.na.drop(), {"some": ("c", "a")})["some"]
    assert np.allclose(whole.among(["c", "a"]).matrices, one.matrices)
    assert np.allclose(whole.among(["c", "a"]).ridge(7).coefficients, one.ridge(7).coefficients)
    assert np.allclose(whole.upto(7) + whole.after(7), whole.matrices.sum(axis=0))


def test_moments_take_one_job(spark, table):
    tracker = spark.sparkContext.statusTracker()
    table.count()
    spark.sparkContext.setJobGroup("moments", "")
    moments.moments_of(table, {"x": ("a", "b"), "y": ("c",), "z": ("a",)})
    jobs = tracker.getJobIdsForGroup("moments")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getJobInfo(j).stageIds for j in jobs]
    assert len(jobs) <= 4 and sum(map(len, stages)) <= 10  # adaptive execution runs the three shuffles as jobs of one action


def test_periods_without_rows_and_empty_tables(spark, table):
    few = table.where("gameweek = 3").withColumn("a", F.lit(None).cast("double")).unionByName(table.where("gameweek > 3"))
    assert {r.cutoff for r in moments.rolling_origin(few, {"x": ("a",)}).collect()} == {4, 7, 8}
    assert moments.rolling_origin(table.limit(0), {"x": ("a",)}).count() == 0
    assert moments.moments_of(table.limit(0), {"x": ("a",)})["x"].ridge(5) is None
    constant = table.withColumn("a", F.lit(2.0))
    assert all(abs(r.coefficients[0]) < 1e-6 for r in moments.rolling_origin(constant, {"x": ("a",)}).collect())
