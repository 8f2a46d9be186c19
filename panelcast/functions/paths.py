"""Columns from file paths and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded(path: Column) -> Column:
    """A path as its folders are named; one that is no valid encoding is taken as it is."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def path_part(path: Column, pattern: str, group: int, dtype: str = "string") -> Column:
    """A regex group of a path, URL-decoded where it is encoded; null where the path does not match."""
    plain = decoded(path)
    part = F.nullif(F.regexp_extract(plain, pattern, group), F.lit(""))
    return part if dtype == "string" else part.try_cast(dtype)


def period_from_name(name: Column, before: str = "gw", after: str = "_predictions.csv", whole: bool = False) -> Column:
    """The number between ``before`` and ``after`` at the end of a file name, in any case.

    ``whole`` asks for the whole name to match, not only its end.
    """
    start = "(?:^|/)" if whole else ""
    return path_part(name, rf"(?i){start}{before}(\d+){after.replace('.', chr(92) + '.')}$", 1, "int")
