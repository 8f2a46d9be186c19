"""Lag and rolling features that look only at earlier rows of the same entity.

``mode="entity"`` is the default: every frame stays inside its entity. ``mode="global"`` lags inside the
entity but lets the moving frame run over the whole table in key order, so the first rows of an entity
also see the last rows of the entity before it.

``hot_rows`` is for panels whose entities have no bound on their number of rows. Entities above that
count are computed in blocks (see ``blocks``), so one entity never has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.functions.features import reached, total_of
from panelcast.operators.blocks import number_rows, with_halo
from panelcast.operators.conform import with_absent_as_null
from panelcast.session import checked_broadcast

HOT_ROWS = 1_000_000
BLOCK_ROWS = 500_000


@dataclass(frozen=True)
class Lag:
    """The value of the row before."""

    column: str
    name: str


@dataclass(frozen=True)
class Roll:
    """``agg`` (avg or sum) over up to ``width`` earlier rows; null when none of them has a value."""

    column: str
    agg: str
    width: int
    name: str


FORM_LAST3 = (
    Lag("event_points", "pts_prev_gw"),
    Roll("event_points", "avg", 3, "pts_avg_last3"),
    Roll("minutes", "avg", 3, "mins_avg_last3"),
    Roll("played60", "avg", 3, "played60_rate_last3"),
)

FORM_ALL = (
    FORM_LAST3[0],
    *(
        Roll(column, agg, width, f"{stem}_last{width}")
        for column, agg, stem in (
            ("event_points", "avg", "pts_avg"),
            ("minutes", "avg", "mins_avg"),
            ("played60", "avg", "played60_rate"),
            ("xgi", "avg", "xgi_avg"),
            ("total_shots", "sum", "shots"),
            ("clean_sheets", "avg", "cs_rate"),
            ("goals_conceded", "avg", "gc_avg"),
        )
        for width in (3, 5)
    ),
)

OPTIONAL_INPUTS = {"total_shots": "double", "clean_sheets": "double", "goals_conceded": "double"}


def with_form_inputs(df: DataFrame, minutes_needed: float = 60) -> DataFrame:
    """Add the inputs of the form features: the played-60 flag, xgi, and nulls for absent sources."""
    if {"expected_goals", "expected_assists"} <= set(df.columns):
        xgi = total_of(F.col("expected_goals"), F.col("expected_assists"))
    else:
        xgi = F.lit(None).cast("double")
    df = with_absent_as_null(df, OPTIONAL_INPUTS)
    return df.withColumns({"played60": reached(F.col("minutes"), minutes_needed), "xgi": xgi})


def _aggregate(spec: Roll, value: Column) -> Column:
    return {"avg": F.avg, "sum": F.sum}[spec.agg](value)


def past_only(specs: Sequence[Lag | Roll], window) -> dict[str, Column]:
    """The columns of ``specs`` over rows before the current one in ``window``."""
    return {
        s.name: F.lag(s.column).over(window)
        if isinstance(s, Lag)
        else _aggregate(s, F.col(s.column)).over(window.rowsBetween(-s.width, -1))
        for s in specs
    }


def widest(specs: Sequence[Lag | Roll]) -> int:
    """How many rows back the specs look."""
    return max(s.width if isinstance(s, Roll) else 1 for s in specs)


def rolling_features(
    df: DataFrame,
    specs: Sequence[Lag | Roll] = FORM_LAST3,
    keys: Sequence[str] = ("season", "id"),
    order: Sequence[str] = ("gameweek",),
    mode: str = "entity",
    hot_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the columns of ``specs``. ``order`` must be unique inside an entity.

    Without ``hot_rows`` an entity must be bounded, as in a panel with one row per entity and period.
    """
    if mode == "global":
        return _over_whole_table(df, specs, keys, order, block_rows)
    if mode != "entity":
        raise ValueError(f"mode must be entity or global, not {mode!r}")
    features = past_only(specs, W.partitionBy(*keys).orderBy(*order))
    if hot_rows is None:
        return df.withColumns(features)
    # Map-side partial counts make this pass cheap for any skew; at most rows / hot_rows keys qualify.
    counts = df.groupBy(*[F.col(k).alias(f"_hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > hot_rows).drop("_n").persist()
    if hot.isEmpty():
        return df.withColumns(features)
    hot = checked_broadcast(hot)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    cold = df.join(hot, same, "left_anti").withColumns(features)
    return cold.unionByName(_in_blocks(df.join(hot, same, "left_semi"), specs, keys, order, block_rows))


def _in_blocks(df, specs, keys, order, block_rows) -> DataFrame:
    """Entity windows where one entity spreads over several blocks."""
    halo = with_halo(number_rows(df, [*keys, *order]), widest(specs), block_rows)
    window = W.partitionBy("_block", *keys).orderBy("_row")
    return halo.withColumns(past_only(specs, window)).where(~F.col("_copy")).drop("_row", "_block", "_copy")


def _over_whole_table(df, specs, keys, order, block_rows) -> DataFrame:
    """Lag inside the entity, then frames over the table in key order."""
    halo = with_halo(number_rows(df, [*keys, *order]), widest(specs), block_rows)
    window = W.partitionBy("_block").orderBy("_row")
    same_entity = F.lit(True)
    for key in keys:
        same_entity = same_entity & F.lag(key).over(window).eqNullSafe(F.col(key))
    halo = halo.withColumn("_same", same_entity)
    lagged = {c: f"_lag_{c}" for c in dict.fromkeys(s.column for s in specs)}
    halo = halo.withColumns({
        name: F.when(F.col("_same"), F.lag(column).over(window)) for column, name in lagged.items()
    })
    frames = {
        s.name: F.col(lagged[s.column])
        if isinstance(s, Lag)
        else _aggregate(s, F.col(lagged[s.column])).over(window.rowsBetween(1 - s.width, 0))
        for s in specs
    }
    return (
        halo.withColumns(frames).where(~F.col("_copy"))
        .drop("_row", "_block", "_copy", "_same", *lagged.values())
    )
