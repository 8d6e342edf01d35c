"""Raw lake rows to typed warehouse rows, all symbols in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import epoch_ms_to_time
from ..functions.values import parse
from ..schemas import AMOUNT, PRICE
from ..session import pin

KLINE_FIELDS = (
    "open_ms",
    "openPrice",
    "highPrice",
    "lowPrice",
    "closePrice",
    "volume",
    "close_ms",
    "quoteassetvolume",
    "numberoftrades",
    "takerbaseassetvolume",
    "takerbuyquoteassetvolume",
    "ignored",
)


PRICE_NAMES = (
    "priceChange",
    "priceChangePercent",
    "weightedAvgPrice",
    "prevClosePrice",
    "lastPrice",
    "bidPrice",
    "askPrice",
    "openPrice",
    "highPrice",
    "lowPrice",
)
AMOUNT_FIELDS = ("volume", "quoteassetvolume", "takerbaseassetvolume", "takerbuyquoteassetvolume")

# Types that texts of raw rows have to fit.
TRADE_TYPES = {"price": PRICE, "qty": AMOUNT, "quoteQty": AMOUNT}
KLINE_TYPES = {n: PRICE for n in KLINE_FIELDS[1:5]} | {n: AMOUNT for n in AMOUNT_FIELDS}
TICKER_TYPES = {n: PRICE for n in PRICE_NAMES} | {"volume": AMOUNT}


def clean_trades(raw: DataFrame) -> DataFrame:
    trade_time = epoch_ms_to_time(F.col("time"))
    return raw.select(
        F.col("id").alias("trade_id"),
        "isBuyerMaker",
        "isBestMatch",
        parse(F.col("price"), PRICE).alias("price"),
        parse(F.col("qty"), AMOUNT).alias("qty"),
        parse(F.col("quoteQty"), AMOUNT).alias("quoteQty"),
        trade_time.alias("trade_time"),
        "symbol",
        F.to_date(trade_time).alias("trade_date"),
    )


def name_kline_fields(raw: DataFrame) -> DataFrame:
    """Positional candle fields ``_1`` … ``_12`` by name."""
    return raw.withColumnsRenamed({f"_{i}": name for i, name in enumerate(KLINE_FIELDS, 1)})


def clean_klines(raw: DataFrame) -> DataFrame:
    """Candles without ``kline_id``; the id is given when they are loaded."""
    price = {n: parse(F.col(n), PRICE).alias(n) for n in KLINE_FIELDS[1:5]}
    amount = {
        n: parse(F.col(n), AMOUNT).alias(n)
        for n in AMOUNT_FIELDS
    }
    return name_kline_fields(raw).select(
        epoch_ms_to_time(F.col("open_ms")).alias("opentime"),
        *price.values(),
        amount["volume"],
        epoch_ms_to_time(F.col("close_ms")).alias("closetime"),
        amount["quoteassetvolume"],
        F.col("numberoftrades").cast("bigint").alias("numberoftrades"),
        amount["takerbaseassetvolume"],
        amount["takerbuyquoteassetvolume"],
        "symbol",
    )


def clean_ticker(raw: DataFrame) -> DataFrame:
    """24-hour statistics without ``ticker_id``; the id is given on load."""
    return raw.select(
        *(parse(F.col(name), PRICE).alias(name) for name in PRICE_NAMES),
        parse(F.col("volume"), AMOUNT).alias("volume"),
        epoch_ms_to_time(F.col("openTime")).alias("openTime"),
        epoch_ms_to_time(F.col("closeTime")).alias("closeTime"),
        F.col("firstId").alias("firstTradeId"),
        F.col("lastId").alias("lastTradeId"),
        "count",
        "symbol",
    )


SYMBOL_FIELDS = (
    "status",
    "baseAsset",
    "baseAssetPrecision",
    "quoteAsset",
    "quotePrecision",
    "quoteAssetPrecision",
    "baseCommissionPrecision",
    "quoteCommissionPrecision",
    "icebergAllowed",
    "ocoAllowed",
    "quoteOrderQtyMarketAllowed",
    "allowTrailingStop",
    "cancelReplaceAllowed",
    "isSpotTradingAllowed",
    "isMarginTradingAllowed",
    "defaultSelfTradePreventionMode",
)


PRECISION_TYPES = {n: "int" for n in SYMBOL_FIELDS if n.endswith("Precision")}


def clean_symbols(raw: DataFrame) -> DataFrame:
    """Symbol metadata, one row per distinct load, filters kept for unnesting.

    ``load_hash`` tells apart two different loads of one symbol on one day and
    recognises a load seen before, whatever the order of keys in its filters.
    Rows are told apart by narrow keys; the wide ones move only if some repeat.
    """
    typed = [parse(F.col(n), PRECISION_TYPES[n]).alias(n) if n in PRECISION_TYPES else F.col(n) for n in SYMBOL_FIELDS]
    rules = F.transform("filters", lambda rule: F.array_sort(F.map_entries(rule)))
    rows = pin(
        raw.select(
            *typed,
            F.make_date("year", "month", "day").alias("load_date"),
            F.xxhash64(*SYMBOL_FIELDS, rules).alias("load_hash"),
            "symbol",
            "filters",
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    first = rows.groupBy("symbol", "load_date", "load_hash").agg(F.min("_row").alias("_row"))
    if first.count() < rows.count():
        rows = rows.join(first.select("_row"), "_row", "left_semi")
    return rows.drop("_row")
