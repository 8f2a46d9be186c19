"""Regressors on feature columns with Spark ML: fit, compare, choose, report, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, ImputerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.enrich import attach_names
from panelcast.operators.rank import top_by_group, top_overall
from panelcast.operators.report import with_errors, worst_first
from panelcast.operators.snapshot import next_period_rows
from panelcast.plans.forests import ROWS_IN_DRAW, DeepForest, deep_forest
from panelcast.plans.model_table import (
    EXTENDED_BASIC,
    FEATURE_SETS,
    REQUIRED_VALUES,
    TARGET,
    engineered,
    model_table,
    time_split,
)
from panelcast.session import shared_folder

# The columns of the residual report.
RESIDUAL_COLUMNS = (
    "season", "gameweek", "id", "player_name", "team_short", "position",
    "predicted_points", "actual_points", "error", "abs_error",
)


@dataclass(frozen=True)
class Settings:
    """Model parameters. Trees take Spark's greatest depth where the depth is meant to be free."""

    alpha: float = 1.0
    forest_trees: int = 300
    scoring_trees: int = 200
    forest_depth: int = 30
    boost_rounds: int = 500
    boost_rate: float = 0.05
    boost_depth: int = 6
    boost_min_leaf: int = 20
    max_bins: int = 256
    forest_bins: int = 64  # most of a deep tree's work is counting its small nodes' bins
    forest_min_leaf: int = 1  # with the default trees grow with the rows
    seed: int = 42


# A fit runs hundreds of short jobs over the training rows; tasks of fewer rows only add to their cost.
ROWS_PER_TASK = 50_000


def aligned(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """The rows where every feature and the target have a value."""
    return df.na.drop(subset=[*features, target])


def ridge(train: DataFrame, target: str, settings: Settings) -> LinearRegression:
    """Least squares with penalty ``alpha`` on the squared coefficients, intercept free.

    Spark divides the loss by the row count and scales the penalty by the target's deviation, so its
    parameter for the same solution is alpha * deviation / rows.
    """
    facts = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(target).alias("deviation")).first()
    penalty = settings.alpha * (facts["deviation"] or 0.0) / facts["n"]
    return LinearRegression(
        labelCol=target, predictionCol="predicted_points", regParam=penalty, elasticNetParam=0.0,
        standardization=False, solver="normal",
    )


def forest(trees: int, target: str, settings: Settings, seed: int | None = None) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=target, predictionCol="predicted_points", numTrees=trees, maxDepth=settings.forest_depth,
        maxBins=settings.forest_bins, minInstancesPerNode=settings.forest_min_leaf, featureSubsetStrategy="all",
        seed=settings.seed if seed is None else seed, cacheNodeIds=True, checkpointInterval=10,
    )


def boosting(target: str, settings: Settings) -> GBTRegressor:
    """Boosted trees on all training rows, for every round that is set."""
    return GBTRegressor(
        labelCol=target, predictionCol="predicted_points", maxIter=settings.boost_rounds,
        stepSize=settings.boost_rate, maxDepth=settings.boost_depth, maxBins=settings.max_bins,
        minInstancesPerNode=settings.boost_min_leaf, featureSubsetStrategy="all", seed=settings.seed,
        cacheNodeIds=True, checkpointInterval=10,
    )


def with_checkpoints(spark: SparkSession) -> None:
    """Let long fits cut their lineage in the shared folder, unless the session has a folder set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


# The names of the models.
MODELS = ("Ridge", "RandomForest", "HistGBDT")


def regressor(name: str, train: DataFrame, target: str, settings: Settings):
    """The estimator of one of ``MODELS``, with the parameters that depend on the training rows."""
    if name == "Ridge":
        return ridge(train, target, settings)
    if name == "RandomForest":
        return forest(settings.forest_trees, target, settings)
    if name == "HistGBDT":
        return boosting(target, settings)
    raise ValueError(f"model must be one of {MODELS}, not {name!r}")


@dataclass(frozen=True)
class Fitted:
    """A fitted combination of feature set and model with its errors."""

    feature_set: str
    model: str
    features: tuple[str, ...]
    train_mae: float
    test_mae: float
    fitted: PipelineModel = field(repr=False, compare=False)


def split_errors(predictions: DataFrame, target: str = TARGET) -> dict[str, float]:
    """Mean absolute error by split, in one job."""
    rows = predictions.groupBy("split").agg(F.avg(F.abs(F.col("predicted_points") - F.col(target))).alias("mae"))
    return {r["split"]: r["mae"] for r in rows.collect()}


def model_grid(
    table: DataFrame,
    cutoff: int,
    feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS,
    settings: Settings = Settings(),
    target: str = TARGET,
    models: Sequence[str] = MODELS,
    parallelism: int = 9,
) -> list[Fitted]:
    """Fit every model on every feature set up to the cutoff and measure both sides.

    ``table`` is the engineered model table of one season. A feature set without rows on either side
    gives no result. The rows of the feature sets are kept while their models use them; up to
    ``parallelism`` models are fitted at a time, and all fits use all rows.
    """
    with_checkpoints(table.sparkSession)
    kept: list[DataFrame] = []
    fits: list = []
    for set_name, features in feature_sets.items():
        rows = aligned(table, features, target).select("gameweek", target, *features)
        split = F.when(F.col("gameweek") <= cutoff, F.lit("train")).otherwise(F.lit("test"))
        assembled = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
        rows = assembled.transform(rows)
        rows = rows.select(target, "features", split.alias("split")).persist()
        kept.append(rows)
        sides = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
        if set(sides) == {"train", "test"}:
            train = rows.where("split = 'train'").coalesce(-(-sides["train"] // ROWS_PER_TASK))

            @inheritable_thread_target(table.sparkSession)
            def fitted(model_name, set_name=set_name, features=features, rows=rows, train=train, assembled=assembled) -> Fitted:
                model = regressor(model_name, train, target, settings).fit(train)
                mae = split_errors(model.transform(rows), target)
                pipeline = PipelineModel([assembled, model])
                return Fitted(set_name, model_name, tuple(features), mae["train"], mae["test"], pipeline)

            fits += [(fitted, name) for name in models]
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            return list(pool.map(lambda fit: fit[0](fit[1]), fits))
    finally:
        for rows in kept:
            rows.unpersist()


def grid_table(spark, results: Sequence[Fitted]) -> DataFrame:
    """feature_set, model, n_features_used, train_mae, test_mae in the order of fitting."""
    schema = "ordinal int, feature_set string, model string, n_features_used int, train_mae double, test_mae double"
    rows = [
        (i, r.feature_set, r.model, len(r.features), r.train_mae, r.test_mae) for i, r in enumerate(results)
    ]
    return spark.createDataFrame(rows, schema)


def best_row(metrics: DataFrame, error: str = "test_mae", ordinal: str = "ordinal") -> DataFrame:
    """The row with the lowest error; the first one wins a tie."""
    return metrics.agg(
        F.min_by(F.struct(*metrics.columns), F.struct(error, ordinal)).alias("best")
    ).select("best.*")


def best_of(results: Sequence[Fitted]) -> Fitted | None:
    return min(results, key=lambda r: r.test_mae, default=None)


def evaluation_rows(table: DataFrame, best: Fitted, cutoff: int, period: int, target: str = TARGET) -> DataFrame:
    """The aligned test rows of ``period``, or all test rows when that period has none."""
    _, test = time_split(aligned(table, best.features, target), cutoff)
    chosen = test.where(F.col("gameweek") == period)
    return test if chosen.isEmpty() else chosen


def residuals(table: DataFrame, best: Fitted, names: DataFrame, cutoff: int, period: int, target: str = TARGET) -> DataFrame:
    """Forecasts of the best model next to the actual values with names, worst errors first."""
    rows = evaluation_rows(table, best, cutoff, period, target)
    scored = best.fitted.transform(rows).withColumn("actual_points", F.col(target))
    named = with_errors(attach_names(scored, names), "predicted_points", "actual_points")
    return worst_first(named.select(*RESIDUAL_COLUMNS), ["season", "gameweek", "id"])


@dataclass(frozen=True)
class ScoringModel:
    """Medians for missing features and a forest behind them; ``transform`` grows the trees."""

    filled: ImputerModel
    forest: DeepForest
    kept: tuple[DataFrame, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(self.filled.transform(df)).drop(*self.forest.features)

    def unpersist(self) -> None:
        for rows in self.kept:
            rows.unpersist()


def scoring_model(train: DataFrame, features: Sequence[str] = EXTENDED_BASIC, settings: Settings = Settings(), target: str = TARGET) -> ScoringModel:
    """A forest for scoring, behind medians of the training rows for features missing at scoring time."""
    rows = aligned(as_doubles(train, features), features, target).select(target, *features)
    rows = rows.coalesce(max(1, -(-rows.count() // ROWS_IN_DRAW))).persist()
    filled = Imputer(strategy="median", inputCols=list(features), outputCols=[f"{c}_filled" for c in features]).fit(rows)
    inputs = rows.select(target, *(F.col(c).alias(f"{c}_filled") for c in features))
    trees = deep_forest(
        inputs, [f"{c}_filled" for c in features], target, settings.scoring_trees, settings.forest_depth, settings.forest_bins,
        settings.forest_min_leaf, settings.seed,
    )
    return ScoringModel(filled, trees, (rows, trees.kept))


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@dataclass(frozen=True)
class Forecast:
    """All forecasts of the next period, best first, and the leaderboards."""

    rows: DataFrame

    def export(self) -> DataFrame:
        return self.rows.select("gameweek", "player_name", "team_short", "position", "predicted_points")

    def top(self, n: int = 20) -> DataFrame:
        return top_overall(self.rows, "predicted_points", ["id", "opp_code"], n)

    def top_by_position(self, positions: Sequence[str], n: int = 10) -> DataFrame:
        return top_by_group(self.rows, "position", "predicted_points", ["id", "opp_code"], n, positions)


def forecast_next_period(
    panel: DataFrame,
    members: DataFrame,
    fixtures: DataFrame,
    strengths: DataFrame,
    names: DataFrame,
    features: Sequence[str] = EXTENDED_BASIC,
    settings: Settings = Settings(),
    seasons: Sequence[str] | None = None,
) -> Forecast | None:
    """Train on the finished periods of the latest season (or of ``seasons``) and score the next period.

    None when there is nothing to train on or no fixture to score. Only the seasons to train on are
    turned into a model table; the others are read for it only if the newest one gives no row. The
    table is kept while the newest period and the model are taken from it.
    """
    latest = panel.agg(F.max("season").alias("season")).first()["season"]
    wanted = {latest, *(seasons or ())} - {None}
    for rows in (panel.where(F.col("season").isin(list(wanted))), panel):
        table = engineered(model_table(rows, members, fixtures, strengths)).persist()
        newest = table.agg(F.max(F.struct("season", "gameweek")).alias("newest")).first()["newest"]
        if newest is not None:
            break
        table.unpersist()
    else:
        return None
    season, last_gw = newest["season"], newest["gameweek"]
    train = table.where(F.col("season").isin(list(seasons or [season])) & (F.col("gameweek") <= last_gw))
    train = train.na.drop(subset=list(REQUIRED_VALUES))
    upcoming = next_period_rows(panel, members, fixtures, strengths, season, last_gw)
    if aligned(train, features).isEmpty() or upcoming.isEmpty():
        table.unpersist()
        return None
    model = scoring_model(train, features, settings)
    scored = model.transform(as_doubles(upcoming, features))
    named = attach_names(scored, names).select(
        "season", "gameweek", "id", "opp_code", "player_name", "team_short", "position", "predicted_points"
    ).persist()
    named.count()  # the trees grow once, not with every leaderboard
    model.unpersist()
    table.unpersist()
    return Forecast(named.orderBy(F.desc_nulls_last("predicted_points"), "id", "opp_code"))
