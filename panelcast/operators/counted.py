"""Counts along a plan, taken while the one action on it runs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """Named row counts at several places of one plan.

    ``at`` marks a place; the numbers are there after the first action on a plan that contains all
    marked places, and cost no job of their own. A place that the action runs twice, as both sides of
    a join, counts once.
    """

    def __init__(self):
        self.seen: list[tuple[Observation, tuple[str, ...]]] = []

    def at(self, df: DataFrame, of: Mapping[str, Column]) -> DataFrame:
        """``df``, with the rows counted for which each named condition holds."""
        observation = Observation()
        self.seen.append((observation, tuple(of)))
        return df.observe(observation, *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in of.items()])

    def numbers(self) -> dict[str, int]:
        """All counts, in the order of the places. Waits for the action."""
        return {name: observation.get[name] for observation, names in self.seen for name in names}

    def table(self, spark: SparkSession) -> DataFrame:
        """``step, rows`` of each count."""
        return spark.createDataFrame(list(self.numbers().items()), "step string, rows long")
