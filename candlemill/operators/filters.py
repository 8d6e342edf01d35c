"""Trading-rule filters: an array of maps per symbol to one flat table per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import parse
from ..schemas import FILTER_TYPES

PARENT_KEYS = ("symbol", "filter_type_id")


def explode_filters(versioned: DataFrame) -> DataFrame:
    """One row per filter, with the symbol and version of its parent row."""
    return versioned.select(
        "symbol",
        F.col("filterstype_id").alias("filter_type_id"),
        F.explode("filters").alias("filter"),
    ).select(*PARENT_KEYS, F.col("filter")["filterType"].alias("filterType"), "filter")


def filter_rejects() -> dict[str, Column]:
    """By ``TYPE.column``, the number of values that are present but don't fit."""
    counts = {}
    for kind, target in FILTER_TYPES.items():
        for name, dtype in target.columns.items():
            value = F.col("filter")[name]
            unfit = (F.col("filterType") == kind) & value.isNotNull() & parse(value, dtype).isNull()
            counts[f"{kind}.{name}"] = F.count_if(unfit)
    return counts


def filter_detail(exploded: DataFrame, filter_type: str) -> DataFrame:
    """The typed rows of one filter type; a missing key gives NULL."""
    columns = FILTER_TYPES[filter_type].columns
    return exploded.where(F.col("filterType") == filter_type).select(
        *(parse(F.col("filter")[name], dtype).alias(name) for name, dtype in columns.items()),
        *PARENT_KEYS,
    )


def filter_details(exploded: DataFrame) -> dict[str, DataFrame]:
    """All nine detail tables by warehouse table name."""
    return {kind.table: filter_detail(exploded, name) for name, kind in FILTER_TYPES.items()}


def filter_matrix(exploded: DataFrame) -> DataFrame:
    """How many filters of each known type a symbol version has."""
    return exploded.groupBy(*PARENT_KEYS).agg(
        *(
            F.count_if(F.col("filterType") == name).alias(kind.table.removesuffix("_detail"))
            for name, kind in FILTER_TYPES.items()
        )
    )


def current_versions(versioned: DataFrame) -> DataFrame:
    """The latest version of every symbol."""
    others = [c for c in versioned.columns if c != "symbol"]
    return (
        versioned.groupBy("symbol")
        .agg(F.max_by(F.struct(*others), "filterstype_id").alias("row"))
        .select("symbol", "row.*")
    )
