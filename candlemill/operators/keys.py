"""Identifiers: latest ids, dense sequences, versions and the symbol dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import zero_if_missing
from ..session import pin

BROADCAST_ROWS = 500_000
SALTS = 64
#: A symbol with more than this share of the rows is spread; the sample that tells has this share of them.
HOT_SHARE = 0.005
SAMPLED = 0.01


def latest_ids(table: DataFrame, id_column: str, alias: str = "latest_id") -> DataFrame:
    """Greatest id per symbol, for every symbol at once."""
    return table.groupBy("symbol").agg(F.max(id_column).alias(alias))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written out, and marked for broadcast if it has few (narrow) rows."""
    small = pin(df)
    return F.broadcast(small) if small.count() <= rows else small


def hot_symbols(facts: DataFrame, share: float = HOT_SHARE, fraction: float = SAMPLED) -> DataFrame:
    """Symbols with more than ``share`` of the rows, told from a sample of them.

    There are fewer than ``1 / share``. A symbol near the bound may be missed or
    found too many, which changes where its rows go, not what they become.
    """
    counts = pin(facts.sample(fraction, seed=1).groupBy("symbol").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") > F.lit(total * share)).select("symbol", F.lit(True).alias("_hot"))


def attach_per_symbol(
    facts: DataFrame,
    per_symbol: DataFrame,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    fraction: float = SAMPLED,
) -> DataFrame:
    """Left join of one-row-per-symbol values to facts that may be skewed.

    The small side is written out and counted. Up to ``broadcast_rows`` narrow
    rows it is broadcast; beyond that the facts of hot symbols are spread over
    ``SALTS`` tasks by a hash of ``spread_by``, and only their values are copied.
    """
    small = pin(per_symbol)
    if small.count() <= broadcast_rows:
        return facts.join(F.broadcast(small), "symbol", "left")
    # Fewer than 1 / HOT_SHARE symbols.
    hot = F.broadcast(pin(hot_symbols(facts, fraction=fraction)))
    last = F.when(F.col("_hot"), SALTS - 1).otherwise(0)
    salted = small.join(hot, "symbol", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_hot")
    salt = F.when(F.col("_hot"), F.pmod(F.hash(spread_by), F.lit(SALTS))).otherwise(0)
    return (
        facts.join(hot, "symbol", "left")
        .withColumn("_salt", salt)
        .drop("_hot")
        .join(salted, ["symbol", "_salt"], "left")
        .drop("_salt")
    )


def sequential_ids(
    df: DataFrame,
    group: list[str],
    order: list[str],
    id_column: str,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Ids 1, 2, 3 … per group in ``order``, without one task per group.

    With ``latest``, a group's ids go on from its ``latest_id`` there.

    Rows are range partitioned and sorted, so a large group is spread over many
    partitions, and their positions are written out once, which keeps them
    stable. A group's run inside a partition is then shifted by the rows the
    group has in earlier partitions. There is one run per group plus at most one
    more per partition; so few are broadcast, and the rows are not shuffled a
    second time.
    """
    positioned = pin(
        df.repartitionByRange(*group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_position", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_position", 33))

    runs = positioned.groupBy("_part", *group).agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_first")
    )
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = zero_if_missing(F.sum("_rows").over(earlier)) - F.col("_first") + 1
    if latest is not None:
        runs = runs.join(latest.select(*group, "latest_id"), group, "left")
        shift = shift + zero_if_missing(F.col("latest_id"))
    shifts = broadcast_if_small(
        runs.select(
            F.col("_part").alias("_run_part"),
            *(F.col(c).alias(f"_run_{c}") for c in group),
            shift.alias("_shift"),
        )
    )
    same_run = F.col("_part") == F.col("_run_part")
    for c in group:
        same_run &= F.col(c).eqNullSafe(F.col(f"_run_{c}"))
    return (
        positioned.join(shifts, same_run)
        .withColumn(id_column, F.col("_position") + F.col("_shift"))
        .select(*df.columns, id_column)
    )


def assign_versions(loads: DataFrame, latest: DataFrame | None) -> DataFrame:
    """Version id of every load: the symbol's latest version plus one, two, …

    Only the keys are numbered; they bring the ids to the wide rows.
    """
    order = ["load_date", "load_hash"]
    names = ["symbol", *order]
    numbered = sequential_ids(loads.select(*names), ["symbol"], order, "filterstype_id", latest)
    return loads.join(numbered, names).select(*loads.columns, "filterstype_id")


def extend_symbol_dim(symbols: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows for symbols the dictionary lacks; ids it already gave never change.

    Ids start at 1, so that 0 always means unknown.
    """
    new = symbols.select("symbol").distinct().join(dim, "symbol", "left_anti")
    last: Column = zero_if_missing(dim.agg(F.max("symbol_id")).scalar())
    return sequential_ids(new, [], ["symbol"], "rank").select(
        (F.col("rank") + last).alias("symbol_id"), "symbol"
    )


def with_symbol_id(facts: DataFrame, dim: DataFrame, spread_by: str) -> DataFrame:
    """Facts with their symbol's id, 0 where the symbol is unknown."""
    return attach_per_symbol(facts, dim.select("symbol", "symbol_id"), spread_by).withColumn(
        "symbol_id", zero_if_missing(F.col("symbol_id"))
    )


def first_symbols(dim: DataFrame, n: int = 100) -> DataFrame:
    return dim.orderBy("symbol_id").limit(n)


def top_by(table: DataFrame, column: str) -> DataFrame:
    """The row with the greatest value, found without a full sort."""
    return table.orderBy(F.col(column).desc()).limit(1)
