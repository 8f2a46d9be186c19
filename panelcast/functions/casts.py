"""Lenient and strict casts. A missing number is always null, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole text must be a plain decimal number. `try_cast` alone would read "1d" as 1.0 and "nan" as NaN.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Texts that stand for a missing value in a CSV file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def text_to_number(text: Column, dtype: str = "double") -> Column:
    """Text to number; anything that is not a plain decimal number becomes null."""
    trimmed = F.btrim(text, F.lit(" \t\r\n"))
    number = F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))
    return number if dtype == "double" else number.try_cast(dtype)


def to_number(value: Column, source: T.DataType, dtype: str = "double") -> Column:
    """Lenient cast from a column whose type is known."""
    if isinstance(source, T.StringType):
        return text_to_number(value, dtype)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value.try_cast(dtype)


def to_int_or_fail(value: Column, source: T.DataType, label: str, dtype: str = "int") -> Column:
    """Strict cast: a value that is missing or not a number stops the job."""
    message = F.concat(F.lit(f"{label}: not an integer: "), F.coalesce(value.cast("string"), F.lit("missing")))
    return F.coalesce(to_number(value, source, dtype), F.raise_error(message).cast(dtype))


def percent_to_number(value: Column) -> Column:
    """``"12.3%"`` to 12.3: drop the percent signs, then the lenient cast."""
    return text_to_number(F.replace(value.cast("string"), F.lit("%"), F.lit("")))


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)
