"""The raw lake: ``{root}/{table}/symbol=S/year=YYYY/month=MM/day=DD/``.

A symbol has one record of metadata a day, so a directory a symbol would be one
for each row. That table lies under ``year=YYYY/month=MM/day=DD/`` with the symbol
in its files, unless the lake already has it by symbol; then it stays so.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import lake_date_parts
from ..schemas import lake_schema
from ..session import folder_names, pin

PARTITIONS = ("symbol", "year", "month", "day")
#: Tables with one row per symbol and day.
BY_DAY = ("SymbolInfor",)


def is_by_day(spark: SparkSession, root: str, table: str) -> bool:
    """Whether a lake table has, or will have, its symbols in the files instead of the path."""
    return table in BY_DAY and not any(n.startswith("symbol=") for n in folder_names(spark, f"{root}/{table}"))


def _scan(spark: SparkSession, root: str, table: str, paths: list[str]) -> DataFrame:
    schema = lake_schema(table)
    try:
        return (
            spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*paths)
        )
    except AnalysisException as error:
        # Only "nothing there yet" means no rows; every other failure surfaces.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lake(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A whole lake table; filters on the partition columns prune directories."""
    return _scan(spark, root, table, [f"{root}/{table}"])


def read_lake_day(
    spark: SparkSession, root: str, table: str, day: date, symbol: str | None = None
) -> DataFrame:
    """One day of a lake table, for one symbol or for all of them.

    Only that day's directories are listed, so the cost does not grow with the
    history kept in the lake. A symbol is a filter on the column, not part of
    the path, where some of its characters would be escaped.
    """
    symbols = "" if is_by_day(spark, root, table) else "symbol=*/"
    path = f"{root}/{table}/{symbols}year={day:%Y}/month={day:%m}/day={day:%d}"
    rows = _scan(spark, root, table, [path])
    return rows if symbol is None else rows.where(F.col("symbol") == symbol)


def lake_slice(lake: DataFrame, symbol: str, day: date) -> DataFrame:
    """The same slice as a filter on an opened lake table."""
    return lake.where(
        (F.col("symbol") == symbol)
        & (F.col("year") == day.year)
        & (F.col("month") == day.month)
        & (F.col("day") == day.day)
    )


def write_lake(
    df: DataFrame, root: str, table: str, day: date | Column, replace: bool = False
) -> None:
    """Append raw rows to the lake under a day, or under a date column.

    With ``replace`` the rows take the place of what is stored for the same
    symbols and days, so the write can be repeated. Rebalancing by partition
    keeps files few and lets Spark split a symbol that holds a large share of
    the rows.
    """
    when = day if isinstance(day, Column) else F.lit(day)
    rows = df.withColumns(lake_date_parts(when))
    partitions = PARTITIONS
    if is_by_day(df.sparkSession, root, table):
        partitions = PARTITIONS[1:]
        # As a path would give it back: no symbol is the same as an empty one.
        rows = rows.withColumn("symbol", F.nullif(F.col("symbol").cast("string"), F.lit("")))
        if replace:
            rows = _with_other_symbols(rows, root, table, day)
    rows = rows.hint("rebalance", *PARTITIONS)
    if partitions != PARTITIONS:
        # A symbol's rows are then found by the row groups' bounds.
        rows = rows.sortWithinPartitions(*partitions, "symbol")
    (
        rows.write.partitionBy(*partitions)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite" if replace else "append")
        .parquet(f"{root}/{table}")
    )


def _with_other_symbols(rows: DataFrame, root: str, table: str, day: date | Column) -> DataFrame:
    """``rows``, and what a table by day has of other symbols on the same days.

    Written out, because a day can't be read while it is replaced.
    """
    rows = pin(rows)
    spark = rows.sparkSession
    stored = read_lake(spark, root, table) if isinstance(day, Column) else read_lake_day(spark, root, table, day)
    stored = stored.withColumns(lake_date_parts(F.make_date("year", "month", "day")))

    def same(new: DataFrame) -> Column:
        return reduce(and_, (stored[c].eqNullSafe(new[c]) for c in new.columns))

    days, symbols = rows.select(*PARTITIONS[1:]).distinct(), rows.select(*PARTITIONS).distinct()
    others = stored.join(days, same(days), "left_semi").join(symbols, same(symbols), "left_anti")
    return pin(rows.unionByName(others, allowMissingColumns=True))


def row_counts(raw: DataFrame) -> DataFrame:
    """Rows per symbol of a raw table."""
    return raw.groupBy("symbol").agg(F.count("*").alias("rows"))
