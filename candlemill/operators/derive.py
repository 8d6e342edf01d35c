"""Candles and 24-hour statistics computed from trades."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import between_times, report_bounds, utc_literal
from ..schemas import AMOUNT, PRICE

#: One more than the largest trade id, so that time and id make one number.
ID_RANGE = 1 << 64


def trade_order() -> Column:
    """Sort key for trades: time in seconds, then trade id, as one exact decimal.

    ``min_by``/``max_by`` over a struct cannot be hash aggregated, over a decimal
    they can. Any id of 0 or more fits; a trade without id comes after the
    others of its second.
    """
    seconds = F.unix_seconds("trade_time").cast("decimal(18,0)")
    after_all = F.lit(str(ID_RANGE - 1)).cast("decimal(20,0)")
    number = F.coalesce(F.col("trade_id").cast("decimal(20,0)"), after_all)
    return (seconds * F.lit(str(ID_RANGE)).cast("decimal(20,0)") + number).cast("decimal(38,0)")


def ohlc(order: Column) -> list[Column]:
    """Open, high, low, close, volumes and counts over a group of trades."""
    taker_buy = ~F.col("isBuyerMaker")
    return [
        F.min_by("price", order).alias("openPrice"),
        F.max("price").alias("highPrice"),
        F.min("price").alias("lowPrice"),
        F.max_by("price", order).alias("closePrice"),
        F.sum("qty").alias("volume"),
        F.sum("quoteQty").alias("quoteassetvolume"),
        F.count("*").alias("numberoftrades"),
        F.sum(F.when(taker_buy, F.col("qty")).otherwise(0)).alias("takerbaseassetvolume"),
        F.sum(F.when(taker_buy, F.col("quoteQty")).otherwise(0)).alias(
            "takerbuyquoteassetvolume"
        ),
    ]


def klines_from_trades(trades: DataFrame) -> DataFrame:
    """1-minute candles of every symbol; one shuffle, partly aggregated before it."""
    return (
        trades.groupBy("symbol", F.date_trunc("minute", "trade_time").alias("opentime"))
        .agg(*ohlc(trade_order()))
        .withColumn("closetime", F.col("opentime") + F.expr("INTERVAL 59 SECONDS"))
    )


#: Columns of a candle's part: sums, and first and last price with their place in the order.
PART_KEYS = ["symbol", "opentime"]


def kline_parts(trades: DataFrame) -> DataFrame:
    """What some trades add to each minute; parts of different trades can be merged.

    Besides the sums a part has the order keys of its first and last trade.
    """
    order = trade_order()
    return trades.groupBy("symbol", F.date_trunc("minute", "trade_time").alias("opentime")).agg(
        F.min(order).alias("first_key"), F.max(order).alias("last_key"), *ohlc(order)
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same minute as one; merging merged parts again gives the same."""
    return parts.groupBy(*PART_KEYS).agg(
        F.min("first_key").alias("first_key"),
        F.max("last_key").alias("last_key"),
        F.min_by("openPrice", "first_key").alias("openPrice"),
        F.max("highPrice").alias("highPrice"),
        F.min("lowPrice").alias("lowPrice"),
        F.max_by("closePrice", "last_key").alias("closePrice"),
        *(
            F.sum(c).cast(AMOUNT).alias(c)
            for c in ("volume", "quoteassetvolume")
        ),
        F.sum("numberoftrades").alias("numberoftrades"),
        *(
            F.sum(c).cast(AMOUNT).alias(c)
            for c in ("takerbaseassetvolume", "takerbuyquoteassetvolume")
        ),
    )


def klines_from_parts(parts: DataFrame) -> DataFrame:
    """1-minute candles from parts in any number and order."""
    return (
        merged_parts(parts).drop("first_key", "last_key")
        .withColumn("closetime", F.col("opentime") + F.expr("INTERVAL 59 SECONDS"))
    )


def last_prices(trades: DataFrame) -> DataFrame:
    """Last price per symbol over any length of history."""
    return trades.groupBy("symbol").agg(F.max_by("price", trade_order()).alias("prevClosePrice"))


def last_closes(klines: DataFrame, before: datetime) -> DataFrame:
    """Last price per symbol from stored candles that end before a time.

    Candles know whole minutes only, so ``before`` must be one; trades of a part
    of a minute would be missed.
    """
    if before.second or before.microsecond:
        raise ValueError("the last closes are known for whole minutes only")
    return (
        klines.where(F.col("closetime") < utc_literal(before))
        .groupBy("symbol")
        .agg(F.max_by("closePrice", "opentime").alias("prevClosePrice"))
    )


def last_prices_before(trades: DataFrame, klines: DataFrame, before: datetime) -> DataFrame:
    """Last price per symbol before any time: stored candles, and trades of the part of a minute behind them.

    ``klines`` has to know all trades before that minute; of ``trades`` only
    those of the minute are read.
    """
    minute = before.replace(second=0, microsecond=0)
    closes = last_closes(klines, minute)
    if minute == before:
        return closes
    part = trades.where((F.col("trade_time") >= utc_literal(minute)) & (F.col("trade_time") < utc_literal(before)))
    if "trade_date" in trades.columns:
        part = part.where(F.col("trade_date") == F.lit(minute.date()))
    return (
        last_prices(part).withColumnRenamed("prevClosePrice", "part_price")
        .join(closes, "symbol", "full")
        .select("symbol", F.coalesce("part_price", "prevClosePrice").alias("prevClosePrice"))
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of decimals of scale 10, rounded half up; NULL when dividing by 0.

    A numerator with up to 18 integer digits leaves room for ten decimals in the
    result; a larger one gets the six that Spark keeps for the widest decimals.
    """
    divisor = F.nullif(denominator, F.lit(0))
    return F.coalesce(
        (numerator.try_cast("decimal(28,10)") / divisor).try_cast(PRICE),
        (numerator.cast("decimal(38,10)") / divisor).try_cast(PRICE),
    )


def ticker_from_trades(
    trades: DataFrame,
    as_of: datetime,
    previous: DataFrame | None = None,
) -> DataFrame:
    """24-hour statistics of every symbol that traded in the day up to ``as_of``.

    ``previous(symbol, prevClosePrice)`` may come from ``last_closes`` if
    ``as_of`` is a whole minute, which spares the read of all earlier trades.
    """
    start, end = report_bounds(as_of)
    if previous is None:
        earlier = trades.where(F.col("trade_time") < utc_literal(start))
        previous = last_prices(earlier)
    order = trade_order()
    change = F.col("lastPrice") - F.col("openPrice")
    percent = ratio(change * 100, F.col("openPrice"))
    weighted = ratio(F.col("quoteVolume"), F.col("volume"))
    stats = (
        trades.where(between_times(F.col("trade_time"), start, end))
        .groupBy("symbol")
        .agg(
            F.min_by("price", order).alias("openPrice"),
            F.max("price").alias("highPrice"),
            F.min("price").alias("lowPrice"),
            F.max_by("price", order).alias("lastPrice"),
            F.sum("qty").alias("volume"),
            F.sum("quoteQty").alias("quoteVolume"),
            F.min("trade_id").alias("firstId"),
            F.max("trade_id").alias("lastId"),
            F.count("*").alias("count"),
        )
    )
    return stats.join(previous, "symbol", "left").select(
        "symbol",
        change.try_cast(PRICE).alias("priceChange"),
        percent.alias("priceChangePercent"),
        weighted.alias("weightedAvgPrice"),
        "prevClosePrice",
        "lastPrice",
        "openPrice",
        "highPrice",
        "lowPrice",
        "volume",
        utc_literal(start).alias("openTime"),
        utc_literal(end).alias("closeTime"),
        "firstId",
        "lastId",
        "count",
    )
