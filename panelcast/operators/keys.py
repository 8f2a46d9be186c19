"""A kept dictionary of names and their comparison keys.

Folding a name is the one step of a reconciliation that leaves the JVM, and the same names come back
every period. So each distinct name is folded once: a versioned table holds what is known, an anti join
finds names it lacks, and only these go through the Arrow function.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.text import comparison_key
from panelcast.sources.versions import Change, Version, commit

KEYS = "name string, key string, batch string"


def known_keys(base: Version, table: str = "keys") -> DataFrame:
    """``name, key`` of all names folded so far."""
    if table not in base.names():
        return base.spark.createDataFrame([], KEYS).select("name", "key")
    return base.table(table).select("name", "key")


def unseen_names(base: Version, frames: Sequence[DataFrame], columns: Sequence[str], table: str = "keys") -> DataFrame:
    """The distinct names in these columns of the frames that the dictionary lacks; null is no name."""
    names = None
    for df in frames:
        for column in columns:
            part = df.select(F.col(column).cast("string").alias("name")).where("name IS NOT NULL").distinct()
            names = part if names is None else names.union(part)
    return names.distinct().join(known_keys(base, table), "name", "left_anti")


def extended(base: Version, frames: Sequence[DataFrame], columns: Sequence[str], table: str = "keys") -> Version:
    """The dictionary with every name of the frames, published if there were new ones.

    New names go into a folder of their own; nothing known is written again. Two writers may fold the
    same new name at the same time: its key is the same, and ``with_known_keys`` takes one.
    """
    batch = uuid.uuid4().hex
    new = unseen_names(base, frames, columns, table).select("name", comparison_key(F.col("name")).alias("key"), F.lit(batch).alias("batch"))
    after = commit(base, {table: Change(new, ("batch",))})
    return after


def with_known_keys(df: DataFrame, keys: DataFrame, columns: Sequence[str], prefix: str = "_key_") -> DataFrame:
    """Add the key of each column by joining the dictionary; a null or unknown name has a null key."""
    once = keys.groupBy("name").agg(F.first("key").alias("_key"))
    for column in columns:
        named = once.select(F.col("name").alias(f"_name_{column}"), F.col("_key").alias(f"{prefix}{column}"))
        df = df.join(named, F.col(column) == F.col(f"_name_{column}"), "left").drop(f"_name_{column}")
    return df
