"""Text to typed values, defaults, and counts of what did not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text: Column, dtype: str) -> Column:
    """Text to ``dtype``; NULL where it does not fit, never an error."""
    return text.try_cast(dtype)


def zero_if_missing(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def reject_counts(types: dict[str, str]) -> dict[str, Column]:
    """By column, the number of values that are present but do not fit their type."""
    return {
        name: F.count_if(F.col(name).isNotNull() & parse(F.col(name), dtype).isNull())
        for name, dtype in types.items()
    }


def count_rejects(raw: DataFrame, types: dict[str, str], by: list[str]) -> DataFrame:
    """Values per column that are present in ``raw`` but do not fit their type."""
    counts = (c.alias(f"{name}_rejects") for name, c in reject_counts(types).items())
    return raw.groupBy(*by).agg(F.count("*").alias("rows"), *counts)
