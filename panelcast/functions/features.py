"""Row-wise feature columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def opponent_strength(is_home: Column, at_home: Column, away: Column) -> Column:
    """The opponent's strength at its own side of the fixture: away when we are at home, else at home."""
    return F.when(is_home == 1, away).when(is_home.isNotNull(), at_home)


def reached(value: Column, threshold: float) -> Column:
    """1.0 where ``value`` is at least ``threshold``, else 0.0; missing counts as 0.0."""
    return F.coalesce(value >= threshold, F.lit(False)).cast("double")


def total_of(*values: Column) -> Column:
    """Sum with missing parts as 0."""
    total = F.coalesce(values[0], F.lit(0.0))
    for value in values[1:]:
        total = total + F.coalesce(value, F.lit(0.0))
    return total
