"""Comparison keys without case and accents, and tags that are safe in file names."""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def _folding(trim_and_lower: bool):
    """An Arrow function that drops combining marks after NFKD.

    The inner function holds all it needs, so executors do not have to import this package. Marks are
    dropped with one table lookup over the characters of a whole batch.
    """
    marks = [code for code in range(sys.maxunicode + 1) if unicodedata.combining(chr(code))]

    def fold(values: pd.Series) -> pd.Series:
        present = values.dropna()
        if present.empty:
            return values
        if trim_and_lower:
            present = present.str.strip().str.lower()
        present = present.str.normalize("NFKD")
        is_mark = np.zeros(0x110000, dtype=bool)
        is_mark[marks] = True
        codes = np.frombuffer("".join(present).encode("utf-32-le"), dtype=np.uint32)
        keep = ~is_mark[codes]
        plain = codes[keep].tobytes().decode("utf-32-le")
        ends = np.concatenate([[0], np.cumsum(keep)])[np.cumsum(present.str.len())]
        starts = np.concatenate([[0], ends[:-1]])
        folded = [plain[start:end] for start, end in zip(starts, ends)]
        return pd.Series(folded, index=present.index, dtype=object).reindex(values.index)

    # The optimizer repeats a deterministic function in the null filters of a join; this one runs once.
    return F.pandas_udf(fold, T.StringType()).asNondeterministic()


_fold_key = _folding(trim_and_lower=True)
_fold_tag = _folding(trim_and_lower=False)


def _python_only_beyond_ascii(text: Column, native: Column, udf) -> Column:
    # Plain ASCII has no accents and stays in the JVM: the Arrow function gets and gives null for it.
    return F.coalesce(udf(F.when(text.rlike(r"[^\x00-\x7F]"), text)), native)


def comparison_key(text: Column) -> Column:
    """Trimmed, lower-cased, NFKD-normalised text without combining marks; null stays null."""
    return _python_only_beyond_ascii(text, F.lower(F.btrim(text, F.lit(ASCII_SPACE))), _fold_key)


def safe_tag(text: Column, empty: str = "UNK") -> Column:
    """Text for a file name: no accents, other characters as ``_``, and ``empty`` if nothing is left."""
    plain = _python_only_beyond_ascii(text, text, _fold_tag)
    cleaned = F.btrim(F.regexp_replace(plain, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(empty))


def contains_ignoring_case(text: Column, needle: str) -> Column:
    """True where ``text`` holds ``needle`` in any case; null counts as false."""
    return F.coalesce(F.lower(text).contains(needle.lower()), F.lit(False))
