"""Bring a table to a declared set of columns and types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions import casts


class MissingColumns(KeyError):
    """A required column is absent."""


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stop unless every column is present; needs no job."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumns(f"missing {absent}; present {df.columns}")
    return df


class RepeatedKeys(ValueError):
    """Rows share a key that must be unique."""


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key that more than one row has, with its ``rows``; null counts as a value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str] = ("season", "gameweek", "id"), samples: int = 5) -> DataFrame:
    """Stop with a few samples if a key occurs twice, for one grouped count over the rows."""
    found = repeated_keys(df, keys).orderBy(*keys).limit(samples).collect()
    if found:
        raise RepeatedKeys(f"{list(keys)} repeat: {[tuple(r) for r in found]}")
    return df


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to the wanted columns that exist, in the wanted order."""
    return df.select([c for c in columns if c in df.columns])


def with_absent_as_null(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each absent column as null of the given type."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def conform(df: DataFrame, spec: Mapping[str, str], on_missing: str = "raise") -> DataFrame:
    """Cast the columns of ``spec`` (name to type) leniently and keep all other columns.

    ``on_missing`` says what an absent column becomes: ``raise``, ``null`` or ``drop`` (leave it out).
    """
    if on_missing == "raise":
        require(df, list(spec))
    elif on_missing == "null":
        df = with_absent_as_null(df, spec)
    elif on_missing != "drop":
        raise ValueError(f"on_missing must be raise, null or drop, not {on_missing!r}")
    return lenient(df, {c: t for c, t in spec.items() if c in df.columns})


def lenient(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that cannot be read becomes null."""
    if not spec:
        return df
    return df.withColumns({
        c: F.col(c).cast("string") if t == "string" else casts.to_number(F.col(c), df.schema[c].dataType, t)
        for c, t in spec.items()
    })


def strict_int(df: DataFrame, columns: Sequence[str], dtype: str = "int") -> DataFrame:
    """Cast to integer; the job fails on a value that is missing or unreadable."""
    return df.withColumns({
        c: casts.to_int_or_fail(F.col(c), df.schema[c].dataType, c, dtype) for c in columns
    })


def percent_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clean text such as ``"12.3%"`` in those columns that exist."""
    present = {c: casts.percent_to_number(F.col(c)) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def first_present(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate that is a column."""
    for name in candidates:
        if name in df.columns:
            return name
    raise MissingColumns(f"none of {list(candidates)} in {df.columns}")


def resolve_alias(df: DataFrame, name: str, aliases: Sequence[str]) -> DataFrame:
    """Rename the first alias found to ``name``, unless ``name`` is there already."""
    if name in df.columns:
        return df
    return df.withColumnRenamed(first_present(df, aliases), name)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows where every one of the columns that exist has a value."""
    return df.na.drop(subset=[c for c in columns if c in df.columns])
