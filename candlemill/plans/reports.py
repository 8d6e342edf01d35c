"""Report tables: trades per symbol, running totals, per-symbol series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import between_times, report_bounds, utc_literal
from ..functions.values import zero_if_missing


def trades_in_window(trades: DataFrame, as_of: datetime) -> DataFrame:
    """Trades of the day up to ``as_of``, both bounds included.

    The range on ``trade_date``, where the table has it, prunes partitions.
    """
    previous, current = report_bounds(as_of)
    rows = trades.where(between_times(F.col("trade_time"), previous, current))
    if "trade_date" in trades.columns:
        rows = rows.where(
            F.col("trade_date").between(F.lit(previous.date()), F.lit(current.date()))
        )
    return rows


def daily_trade_counts(trades: DataFrame, as_of: datetime) -> DataFrame:
    """Trades per symbol in the day up to ``as_of``."""
    return (
        trades_in_window(trades, as_of)
        .groupBy("symbol")
        .agg(F.count("*").alias("NumberOfTrades"))
    )


def daily_ledger(trades: DataFrame) -> DataFrame:
    """Trades per calendar day.

    Where the table is partitioned by day, only the numbers of rows in its
    files are read.
    """
    day = F.col("trade_date") if "trade_date" in trades.columns else F.to_date("trade_time")
    return trades.groupBy(day.alias("day")).agg(F.count("*").alias("NumberOfTrades"))


def running_totals(ledger: DataFrame) -> DataFrame:
    """Total so far for every ledger day.

    The window has no partition key: its input is one row per calendar day,
    whatever the number of trades.
    """
    return ledger.select(
        "day",
        "NumberOfTrades",
        F.sum("NumberOfTrades")
        .over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow))
        .alias("TotalTrades"),
    )


def total_trades(ledger: DataFrame, trades: DataFrame, as_of: datetime) -> DataFrame:
    """All trades up to ``as_of``: whole days from the ledger, the last day from its trades.

    Every trade counts once, whatever the hour of the report and however late
    it was loaded; without any the total is 0, not NULL.
    """
    day = as_of.date()
    last = trades.where((F.col("trade_time") >= F.lit(day).cast("timestamp")) & (F.col("trade_time") <= utc_literal(as_of)))
    if "trade_date" in trades.columns:
        last = last.where(F.col("trade_date") == F.lit(day))
    parts = ledger.where(F.col("day") < F.lit(day)).select(F.col("NumberOfTrades").alias("n"))
    parts = parts.unionByName(last.agg(F.count("*").alias("n")))
    return parts.agg(zero_if_missing(F.sum("n")).alias("TotalTrades"))


def symbol_trades(trades: DataFrame, symbol: str, as_of: datetime) -> DataFrame:
    """One symbol's trades in the day up to ``as_of``, by time."""
    return (
        trades_in_window(trades.where(F.col("symbol") == symbol), as_of)
        .select("trade_id", "price", "qty", "trade_time")
        .orderBy("trade_time", "trade_id")
    )


def symbol_klines(klines: DataFrame, symbol: str, as_of: datetime) -> DataFrame:
    """One symbol's candles in the day up to ``as_of``, by time."""
    previous, current = report_bounds(as_of)
    return (
        klines.where(F.col("symbol") == symbol)
        .where(between_times(F.col("opentime"), previous, current))
        .select("opentime", "openPrice", "closePrice", "highPrice", "lowPrice")
        .orderBy("opentime")
    )
