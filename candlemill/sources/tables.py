"""Market data derived from the given tables.

``events`` are trades of a few symbols, or of many when a user is the symbol;
``orders`` and ``lineitem`` are larger sets of trades; ``part`` is symbol
metadata.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import report_bounds, time_to_epoch_ms
from ..operators.derive import klines_from_trades, ticker_from_trades
from ..schemas import AMOUNT, PRICE

AS_OF = datetime(2024, 1, 15, 12, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _naive(moment: datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(f"{moment:%Y-%m-%d %H:%M:%S}"))


def events_until(spark: SparkSession, sf_dir: str, day_up_to: datetime | None) -> DataFrame:
    """Events, or those of one report day.

    Trade times are cut to seconds, so the whole last second belongs to the
    range. The range is on the stored column and reaches the scan.
    """
    events = table(spark, sf_dir, "events")
    if day_up_to is None:
        return events
    low, high = report_bounds(day_up_to)
    return events.where(
        (F.col("ts") >= _naive(low)) & (F.col("ts") < _naive(high) + F.expr("INTERVAL 1 SECOND"))
    )


def raw_trades(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """Trades as the lake holds them: decimal text and epoch milliseconds."""
    price = F.col("value").cast(PRICE)
    qty = F.get_json_object("props", "$.k").cast("decimal(10,0)")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        price.cast("string").alias("price"),
        qty.cast("string").alias("qty"),
        (price * qty).cast(AMOUNT).cast("string").alias("quoteQty"),
        time_to_epoch_ms(F.col("ts")).alias("time"),
        (F.col("user_id") % 2 == 0).alias("isBuyerMaker"),
        F.lit(True).alias("isBestMatch"),
        F.col(symbol).cast("string").alias("symbol"),
    )


def trades(
    spark: SparkSession,
    sf_dir: str,
    symbol: str = "event_type",
    day_up_to: datetime | None = None,
) -> DataFrame:
    """Trades as the warehouse holds them."""
    price = F.col("value").cast(PRICE)
    qty = F.get_json_object("props", "$.k").cast("decimal(10,0)")
    trade_time = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return events_until(spark, sf_dir, day_up_to).select(
        F.col("event_id").alias("trade_id"),
        (F.col("user_id") % 2 == 0).alias("isBuyerMaker"),
        F.lit(True).alias("isBestMatch"),
        price.alias("price"),
        qty.cast(AMOUNT).alias("qty"),
        (price * qty).cast(AMOUNT).alias("quoteQty"),
        trade_time.alias("trade_time"),
        F.col(symbol).cast("string").alias("symbol"),
        F.to_date("ts").alias("trade_date"),
    )


def order_trades(spark: SparkSession, sf_dir: str, symbol: str = "o_orderpriority") -> DataFrame:
    """Orders as trades of quantity 1; several share a time, the id breaks ties."""
    price = F.col("o_totalprice").cast(PRICE)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trade_id"),
        (F.col("o_orderstatus") == "F").alias("isBuyerMaker"),
        F.lit(True).alias("isBestMatch"),
        price.alias("price"),
        F.lit(1).cast(AMOUNT).alias("qty"),
        price.cast(AMOUNT).alias("quoteQty"),
        F.col("o_orderdate").cast("timestamp").alias("trade_time"),
        F.col(symbol).cast("string").alias("symbol"),
        F.to_date("o_orderdate").alias("trade_date"),
    )


def line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades of a supplier; they have no unique id."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.col("l_quantity").cast(AMOUNT).alias("qty"),
        F.col("l_shipdate").cast("timestamp").alias("trade_time"),
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("trade_date"),
    )


def raw_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles as the exchange sends them: twelve positional fields."""
    k = klines_from_trades(trades(spark, sf_dir))
    text = {
        2: "openPrice",
        3: "highPrice",
        4: "lowPrice",
        5: "closePrice",
        6: "volume",
        8: "quoteassetvolume",
        10: "takerbaseassetvolume",
        11: "takerbuyquoteassetvolume",
    }
    return k.select(
        time_to_epoch_ms(F.col("opentime")).alias("_1"),
        *(F.col(text[i]).cast("string").alias(f"_{i}") for i in range(2, 7)),
        (time_to_epoch_ms(F.col("closetime")) + 999).alias("_7"),
        F.col(text[8]).cast("string").alias("_8"),
        F.col("numberoftrades").alias("_9"),
        F.col(text[10]).cast("string").alias("_10"),
        F.col(text[11]).cast("string").alias("_11"),
        F.lit("0").alias("_12"),
        "symbol",
    )


def raw_tickers(
    spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF, symbol: str = "user_id"
) -> DataFrame:
    """24-hour statistics as the exchange sends them.

    Order-book bid and ask do not follow from trades; the last price stands in.
    """
    t = ticker_from_trades(trades(spark, sf_dir, symbol), as_of)
    prices = (
        "priceChange",
        "priceChangePercent",
        "weightedAvgPrice",
        "prevClosePrice",
        "lastPrice",
        "openPrice",
        "highPrice",
        "lowPrice",
        "volume",
    )
    return t.select(
        "symbol",
        *(F.col(name).cast("string").alias(name) for name in prices),
        F.col("lastPrice").cast("string").alias("bidPrice"),
        F.col("lastPrice").cast("string").alias("askPrice"),
        time_to_epoch_ms(F.col("openTime")).alias("openTime"),
        time_to_epoch_ms(F.col("closeTime")).alias("closeTime"),
        "firstId",
        "lastId",
        "count",
    )


def raw_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol metadata: one load of every part, and a later load of some types."""
    part = table(spark, sf_dir, "part").selectExpr(
        "*", "CAST(p_retailprice AS DECIMAL(12,2)) AS p", "14 AS day"
    )
    later = part.where("p_type IN ('ECONOMY', 'PROMO')").withColumns(
        {"p": F.expr("CAST(p + 1 AS DECIMAL(12,2))"), "day": F.lit(15)}
    )
    return part.unionByName(later).selectExpr(
        "CAST(p_partkey AS STRING) AS symbol",
        "IF(day = 14, 'TRADING', 'BREAK') AS status",
        "p_brand AS baseAsset",
        "p_type AS quoteAsset",
        "CAST(p_size AS BIGINT) AS baseAssetPrecision",
        "CAST(p_size AS BIGINT) AS quotePrecision",
        "CAST(p_size AS BIGINT) AS quoteAssetPrecision",
        "CAST(p_size AS BIGINT) AS baseCommissionPrecision",
        "CAST(p_size AS BIGINT) AS quoteCommissionPrecision",
        "p_size > 25 AS icebergAllowed",
        "true AS ocoAllowed",
        "true AS quoteOrderQtyMarketAllowed",
        "true AS allowTrailingStop",
        "true AS cancelReplaceAllowed",
        "true AS isSpotTradingAllowed",
        "false AS isMarginTradingAllowed",
        "'NONE' AS defaultSelfTradePreventionMode",
        f"{FILTERS} AS filters",
        "2024 AS year",
        "1 AS month",
        "day",
    )


# Filters of every type: some absent, some twice, one unknown, one key missing.
FILTERS = """concat(
  array(
    map('filterType', 'PRICE_FILTER', 'minPrice', string(p), 'maxPrice', string(p * 100),
        'tickSize', '0.01'),
    map('filterType', 'LOT_SIZE', 'minQty', '0.001', 'maxQty', string(p_size * 1000),
        'stepSize', '0.001'),
    map('filterType', 'MARKET_LOT_SIZE', 'minQty', '0', 'maxQty', string(p_size * 100),
        'stepSize', '0'),
    map('filterType', 'TRAILING_DELTA', 'minTrailingBelowDelta', '10',
        'maxTrailingBelowDelta', string(p_size + 2000), 'minTrailingAboveDelta', '10',
        'maxTrailingAboveDelta', string(p_size + 3000)),
    map('filterType', 'PERCENT_PRICE_BY_SIDE', 'bidMultiplierUp', '5',
        'bidMultiplierDown', '0.2', 'askMultiplierUp', '5.5', 'askMultiplierDown', '0.25',
        'avgPriceMins', string(p_size)),
    map_concat(
      map('filterType', 'NOTIONAL', 'minNotional', string(p), 'maxNotional', string(p * 1000),
          'avgPriceMins', string(p_size), 'applyMinToMarket', string(p_size > 25)),
      IF(p_type = 'SMALL', map(), map('applyMaxToMarket', 'false'))),
    map('filterType', 'MAX_NUM_ORDERS', 'maxNumOrders', string(p_size + 200)),
    map('filterType', 'MAX_NUM_ALGO_ORDERS', 'maxNumAlgoOrders', '5'),
    map('filterType', 'UNKNOWN_RULE', 'limit', '1')),
  IF(p_type = 'SMALL', array(), array(map('filterType', 'ICEBERG_PARTS', 'limit', string(p_size)))),
  IF(p_type = 'PROMO', array(map('filterType', 'LOT_SIZE', 'minQty', '1',
                                 'maxQty', string(p_size), 'stepSize', '1')), array()))"""
