"""From panel, members, fixtures and strengths to the table that models are trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.casts import to_number
from panelcast.operators.conform import drop_missing, keep_existing, percent_columns, with_absent_as_null
from panelcast.operators.counted import Counts
from panelcast.operators.enrich import attach_context
from panelcast.operators.rolling import FORM_LAST3, rolling_features, with_form_inputs
from panelcast.operators.snapshot import SNAPSHOT_COLUMNS

TARGET = "event_points"

# The named feature sets.
BASELINE = (
    "pts_prev_gw", "pts_avg_last3", "mins_avg_last3", "played60_rate_last3",
    "now_cost", "selected_by_percent", "form",
    "is_home", "team_elo", "opp_elo", "opp_def_strength",
)
EXTENDED_BASIC = (*BASELINE, "team_code", "opp_code")
EXTENDED_INTERACT = (*EXTENDED_BASIC, "elo_diff", "form_x_home")
FEATURE_SETS = {
    "baseline": BASELINE, "extended_basic": EXTENDED_BASIC, "extended_interact": EXTENDED_INTERACT,
}

MODEL_COLUMNS = ("season", "gameweek", "id", *EXTENDED_BASIC, "minutes", TARGET)
REQUIRED_VALUES = ("pts_prev_gw", "opp_def_strength", TARGET)


def model_table(
    panel: DataFrame,
    members: DataFrame,
    fixtures: DataFrame,
    strengths: DataFrame,
    specs: Sequence = FORM_LAST3,
    columns: Sequence[str] = MODEL_COLUMNS,
    fixtures_first: bool = False,
    counts: Counts | None = None,
) -> DataFrame:
    """One row per entity, period and fixture that has a past, an opponent strength and a target.

    Features are rolled over one row per entity and period, then fixtures fan out, so a double fixture
    never sees its own result. ``fixtures_first`` rolls after the fan-out instead, in the order of
    opponent and side inside a period; there the second fixture of a period does see it. ``counts``
    gets what each join leaves without a partner and each requirement drops.
    """
    counts = counts or Counts()
    panel = with_form_inputs(panel)
    if fixtures_first:
        rows = attach_context(panel, members, fixtures, strengths, counts)
        rows = rolling_features(rows, specs, order=("gameweek", "opp_code", "is_home"))
    else:
        rows = attach_context(rolling_features(panel, specs), members, fixtures, strengths, counts)
    rows = counts.at(rows, {f"lacks_{c}": F.col(c).isNull() for c in REQUIRED_VALUES})
    return counts.at(drop_missing(keep_existing(rows, columns), REQUIRED_VALUES), {"kept": F.lit(True)})


def engineered(df: DataFrame) -> DataFrame:
    """Clean the snapshot columns and add ``elo_diff`` and ``form_x_home``; absent sources give null."""
    df = percent_columns(df, SNAPSHOT_COLUMNS)
    had = set(df.columns)
    df = with_absent_as_null(df, dict.fromkeys(("team_elo", "opp_elo", "form", "is_home"), "double"))
    form, is_home = (to_number(F.col(c), df.schema[c].dataType) for c in ("form", "is_home"))
    df = df.withColumns({"elo_diff": F.col("team_elo") - F.col("opp_elo"), "form_x_home": form * is_home})
    return df.select(*[c for c in df.columns if c in had or c in ("elo_diff", "form_x_home")])


def time_split(df: DataFrame, cutoff: int, period: str = "gameweek") -> tuple[DataFrame, DataFrame]:
    """(rows up to the cutoff, rows after it)."""
    return df.where(F.col(period) <= cutoff), df.where(F.col(period) > cutoff)
