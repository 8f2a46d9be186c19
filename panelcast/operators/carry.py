"""Rolling features carried from period to period.

Lags and frames look back a few rows of the same entity, so the last rows of every entity are all that
older periods still have to say. They are kept as a state; a new period is rolled from the state and
its own rows, and the state moves on. Older periods are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.operators.rolling import Lag, Roll, past_only, widest
from panelcast.sources.versions import Change, Version, commit


def state_columns(specs: Sequence[Lag | Roll], keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*keys, *order, *(s.column for s in specs)]))


def tail(rows: DataFrame, specs: Sequence[Lag | Roll], keys: Sequence[str] = ("season", "id"), order: Sequence[str] = ("gameweek",)) -> DataFrame:
    """The state after ``rows``: of every entity the last rows that the widest frame can reach."""
    last = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    kept = rows.select(*state_columns(specs, keys, order)).withColumn("_back", F.row_number().over(last))
    return kept.where(F.col("_back") <= widest(specs)).drop("_back")


def rolled_on(
    state: DataFrame, new: DataFrame, specs: Sequence[Lag | Roll], keys: Sequence[str] = ("season", "id"), order: Sequence[str] = ("gameweek",)
) -> DataFrame:
    """``new`` with the columns of ``specs``, as if all rows before it stood in one table with it.

    ``new`` may hold several periods. A row at or before the last one that the state has of its
    entity would change features that are already out: it stops the job.
    """
    columns = new.columns
    both = state.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    place = F.struct(*order)
    entity = W.partitionBy(*keys)
    features = past_only(specs, entity.orderBy(*order))
    carried = F.max(F.when(~F.col("_new"), place)).over(entity)
    rows = both.withColumns(features | {"_late": F.col("_new") & F.coalesce(place <= carried, F.lit(False))})
    late = F.raise_error(F.concat(F.lit("a row is not later than the state of its entity: "), F.to_json(F.struct(*keys, *order))))
    return rows.where(F.when(F.col("_late"), late.cast("boolean")).otherwise(F.col("_new"))).select(*columns, *features)


def advance(
    base: Version,
    new: DataFrame,
    specs: Sequence[Lag | Roll],
    keys: Sequence[str] = ("season", "id"),
    order: Sequence[str] = ("gameweek",),
    group: str = "season",
    features: str = "features",
    state: str = "state",
) -> Version:
    """Publish the features of the new periods and the state after them, both or neither.

    ``group`` is the one of ``keys`` by which the state is stored; only the groups met in ``new`` are
    read and replaced, and of the features only new periods are written. If the state has moved on
    since ``base``, or the same rows come twice, nothing is published.
    """
    if state in base.names():
        groups = [r[0] for r in new.select(group).distinct().collect()]  # seasons, a few
        known = base.table(state).where(F.col(group).isin(groups))
    else:
        known = new.limit(0).select(*state_columns(specs, keys, order))
    rolled = rolled_on(known, new, specs, keys, order)
    after = tail(known.unionByName(new.select(*known.columns)), specs, keys, order)
    return commit(base, {features: Change(rolled, (group, *order)), state: Change(after, (group,))})
