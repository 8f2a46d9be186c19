"""Ridge regressions at every cutoff from one pass over the rows.

All that a ridge fit needs of its rows are sums of products of features and target, and sums add up.
One aggregate gives them period by period; running totals over the periods give them for every cutoff,
and rows and columns of the matrix for every subset of the features. Each fit is then a small solve on
the driver, and squared errors on later periods come from the same sums, so an evaluation that moves
its origin through all periods needs no refit and no second pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.plans.model_table import FEATURE_SETS, TARGET


def period_moments(table: DataFrame, features: Sequence[str], target: str = TARGET, period: str = "gameweek") -> DataFrame:
    """``period, moments``: sums of the products of every two of 1, the features and the target.

    Rows that lack one of them do not count. Products are listed row by row of the lower triangle.
    """
    values = [F.lit(1.0), *(F.col(c).cast("double") for c in (*features, target))]
    rows = table.na.drop(subset=[*features, target]).select(F.col(period).alias("period"), *(v.alias(f"v{i}") for i, v in enumerate(values)))
    products = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")) for i in range(len(values)) for j in range(i + 1)]
    return rows.groupBy("period").agg(F.array(*products).alias("moments"))


@dataclass(frozen=True)
class Solution:
    """A ridge fit: its rows, coefficients in the order of ``features``, and intercept."""

    features: tuple[str, ...]
    rows: int
    coefficients: np.ndarray
    intercept: float

    def squared_errors(self, moments: np.ndarray) -> float:
        """The sum of squared errors over the rows behind ``moments`` of the same features."""
        weights = np.r_[-self.intercept, -self.coefficients, 1.0]
        return max(0.0, float(weights @ moments @ weights))


@dataclass(frozen=True)
class Moments:
    """The moment matrices of each period, in order of the periods, for 1, ``features`` and target."""

    features: tuple[str, ...]
    periods: tuple
    matrices: np.ndarray

    def upto(self, cutoff) -> np.ndarray:
        """The moments of all periods up to the cutoff."""
        return self.matrices[[p <= cutoff for p in self.periods]].sum(axis=0)

    def after(self, cutoff) -> np.ndarray:
        return self.matrices[[p > cutoff for p in self.periods]].sum(axis=0)

    def among(self, features: Sequence[str]) -> Moments:
        """The moments of fewer features, over the same rows."""
        at = [0, *(1 + self.features.index(f) for f in features), len(self.features) + 1]
        return Moments(tuple(features), self.periods, self.matrices[:, at][:, :, at])

    def ridge(self, cutoff, alpha: float = 1.0) -> Solution | None:
        """Least squares with penalty ``alpha`` on the squared coefficients, intercept free; None without rows."""
        return solved(self.features, self.upto(cutoff), alpha)


def solved(features: Sequence[str], moments: np.ndarray, alpha: float) -> Solution | None:
    rows = moments[0, 0]
    if not rows:
        return None
    means = moments[0, 1:] / rows
    centred = moments[1:, 1:] - rows * np.outer(means, means)
    k = len(features)
    left = centred[:k, :k] + alpha * np.eye(k)
    coefficients = np.linalg.lstsq(left, centred[:k, k], rcond=None)[0]
    return Solution(tuple(features), int(rows), coefficients, float(means[k] - means[:k] @ coefficients))


def moments_of(
    table: DataFrame, feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS, target: str = TARGET, period: str = "gameweek"
) -> dict[str, Moments]:
    """The moments of each feature set over the rows that have all its features, in one job.

    One matrix a period and feature set comes to the driver, whatever the number of rows.
    """
    parts = [period_moments(table, f, target, period).select(F.lit(n).alias("name"), "*") for n, f in feature_sets.items()]
    found = reduce(DataFrame.unionByName, parts).collect()
    out = {}
    for name, features in feature_sets.items():
        rows = sorted((r["period"], r["moments"]) for r in found if r["name"] == name and r["period"] is not None)
        size = len(features) + 2
        matrices = np.zeros((len(rows), size, size))
        for matrix, (_, sums) in zip(matrices, rows, strict=True):
            lower = np.tril_indices(size)
            matrix[lower] = sums
            matrix.T[lower] = sums
        out[name] = Moments(tuple(features), tuple(p for p, _ in rows), matrices)
    return out


ORIGINS = (
    "feature_set string, cutoff int, rows long, intercept double, coefficients array<double>, train_rmse double, "
    "next_period int, next_rows long, next_rmse double, test_rows long, test_rmse double"
)


def rolling_origin(
    table: DataFrame, feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS, alpha: float = 1.0, target: str = TARGET, period: str = "gameweek"
) -> DataFrame:
    """A ridge fit at every period that has a later one, with its errors before and after.

    ``next_rmse`` is over the period that follows, ``test_rmse`` over all later ones. Periods without a
    complete row are no cutoffs. Mean absolute errors need the rows: see ``origin_errors``.
    """
    rows = []
    for name, moments in moments_of(table, feature_sets, target, period).items():
        running = np.cumsum(moments.matrices, axis=0)
        for i, cutoff in enumerate(moments.periods[:-1]):
            fit = solved(moments.features, running[i], alpha)
            train, following, rest = running[i], moments.matrices[i + 1], running[-1] - running[i]
            errors = [float(np.sqrt(fit.squared_errors(m) / m[0, 0])) for m in (train, following, rest)]
            rows.append((
                name, cutoff, fit.rows, fit.intercept, fit.coefficients.tolist(), errors[0], moments.periods[i + 1],
                int(following[0, 0]), errors[1], int(rest[0, 0]), errors[2],
            ))
    return table.sparkSession.createDataFrame(rows, ORIGINS)


def origin_errors(
    table: DataFrame, origins: DataFrame, feature_sets: Mapping[str, Sequence[str]] = FEATURE_SETS, target: str = TARGET, period: str = "gameweek"
) -> DataFrame:
    """``feature_set, cutoff, rows, mae``: each row is forecast once a feature set, by the fit before its period.

    ``origins`` has one row a feature set and period, so the join to it is small on that side.
    """
    parts = []
    for name, features in feature_sets.items():
        fits = origins.where(F.col("feature_set") == name).select(
            "feature_set", "cutoff", "intercept", "coefficients", F.col("next_period").alias(period))
        rows = table.na.drop(subset=[*features, target]).join(fits, period)
        terms = [F.col("coefficients")[i] * F.col(f) for i, f in enumerate(features)]
        error = F.abs(F.col(target) - reduce(lambda a, b: a + b, terms, F.col("intercept")))
        parts.append(rows.groupBy("feature_set", "cutoff").agg(F.count(F.lit(1)).alias("rows"), F.avg(error).alias("mae")))
    return reduce(DataFrame.unionByName, parts)
