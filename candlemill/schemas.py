"""Schemas of the lake, the warehouse and the report tables.

Column and table names are fixed values: existing lakes, dashboards and
queries use them. Prices are DECIMAL(20,10); quantities, volumes and notionals
are DECIMAL(38,10), because they can pass ten integer digits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = "decimal(20,10)"
AMOUNT = "decimal(38,10)"

LAKE_PARTITIONS = "symbol string, year int, month int, day int"

# -- lake: fields as the exchange sends them, decimals as text ----------------

RAW_TRADES = (
    "id bigint, price string, qty string, quoteQty string, time bigint, "
    "isBuyerMaker boolean, isBestMatch boolean"
)

# Positional candle fields: open time, open, high, low, close, volume,
# close time, quote volume, trade count, taker base, taker quote, unused.
RAW_KLINES = (
    "_1 bigint, _2 string, _3 string, _4 string, _5 string, _6 string, "
    "_7 bigint, _8 string, _9 bigint, _10 string, _11 string, _12 string"
)

RAW_TICKER = (
    "priceChange string, priceChangePercent string, weightedAvgPrice string, "
    "prevClosePrice string, lastPrice string, bidPrice string, askPrice string, "
    "openPrice string, highPrice string, lowPrice string, volume string, "
    "openTime bigint, closeTime bigint, firstId bigint, lastId bigint, count bigint"
)

RAW_SYMBOLS = (
    "status string, baseAsset string, baseAssetPrecision bigint, quoteAsset string, "
    "quotePrecision bigint, quoteAssetPrecision bigint, "
    "baseCommissionPrecision bigint, quoteCommissionPrecision bigint, "
    "icebergAllowed boolean, ocoAllowed boolean, quoteOrderQtyMarketAllowed boolean, "
    "allowTrailingStop boolean, cancelReplaceAllowed boolean, "
    "isSpotTradingAllowed boolean, isMarginTradingAllowed boolean, "
    "defaultSelfTradePreventionMode string, filters array<map<string,string>>"
)

LAKE = {
    "SymbolInfor": RAW_SYMBOLS,
    "Trades": RAW_TRADES,
    "Klines": RAW_KLINES,
    "Ticker_24h": RAW_TICKER,
}


def lake_schema(table: str) -> T.StructType:
    """Declared schema of one lake table with its partition columns."""
    return T.StructType.fromDDL(f"{LAKE[table]}, {LAKE_PARTITIONS}")


# -- trading-rule types: target table and typed columns -----------------------


@dataclass(frozen=True)
class FilterType:
    table: str
    columns: dict[str, str]


FILTER_TYPES = {
    "PRICE_FILTER": FilterType(
        "price_filter_detail", {"maxPrice": PRICE, "minPrice": PRICE, "tickSize": PRICE}
    ),
    "LOT_SIZE": FilterType(
        "lot_size_filter_detail", {"stepSize": AMOUNT, "maxQty": AMOUNT, "minQty": AMOUNT}
    ),
    "ICEBERG_PARTS": FilterType("iceberg_parts_filter_detail", {"limit": "int"}),
    "MARKET_LOT_SIZE": FilterType(
        "market_lot_size_filter_detail", {"stepSize": AMOUNT, "maxQty": AMOUNT, "minQty": AMOUNT}
    ),
    "TRAILING_DELTA": FilterType(
        "trailing_delta_filter_detail",
        {
            "minTrailingBelowDelta": PRICE,
            "maxTrailingBelowDelta": PRICE,
            "maxTrailingAboveDelta": PRICE,
            "minTrailingAboveDelta": PRICE,
        },
    ),
    "PERCENT_PRICE_BY_SIDE": FilterType(
        "percent_price_by_side_filter_detail",
        {
            "bidMultiplierUp": PRICE,
            "askMultiplierUp": PRICE,
            "bidMultiplierDown": PRICE,
            "avgPriceMins": PRICE,
            "askMultiplierDown": PRICE,
        },
    ),
    "NOTIONAL": FilterType(
        "notional_filter_detail",
        {
            "maxNotional": AMOUNT,
            "minNotional": AMOUNT,
            "avgPriceMins": PRICE,
            "applyMinToMarket": "boolean",
            "applyMaxToMarket": "boolean",
        },
    ),
    "MAX_NUM_ORDERS": FilterType("max_num_orders_filter_detail", {"maxNumOrders": "int"}),
    "MAX_NUM_ALGO_ORDERS": FilterType(
        "max_num_algo_orders_filter_detail", {"maxNumAlgoOrders": "int"}
    ),
}

# -- warehouse and report tables ----------------------------------------------


@dataclass(frozen=True)
class Table:
    columns: str
    partitions: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    #: Number of buckets by the columns of ``order``; tables with the same ones join without a shuffle.
    buckets: int = 0

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


FILTER_BUCKETS = 8

WAREHOUSE = {
    "symbol_infor": Table(
        "status string, baseAsset string, baseAssetPrecision int, quoteAsset string, "
        "quotePrecision int, quoteAssetPrecision int, baseCommissionPrecision int, "
        "quoteCommissionPrecision int, filterstype_id bigint, icebergAllowed boolean, "
        "ocoAllowed boolean, quoteOrderQtyMarketAllowed boolean, "
        "allowTrailingStop boolean, cancelReplaceAllowed boolean, "
        "isSpotTradingAllowed boolean, isMarginTradingAllowed boolean, "
        "defaultSelfTradePreventionMode string, load_hash bigint, symbol string, load_date date",
        ("load_date",),
        ("symbol", "filterstype_id"),
    ),
    "trades": Table(
        "trade_id bigint, isBuyerMaker boolean, isBestMatch boolean, "
        f"price {PRICE}, qty {AMOUNT}, quoteQty {AMOUNT}, trade_time timestamp, "
        "symbol string, trade_date date",
        ("symbol", "trade_date"),
        ("trade_time", "trade_id"),
    ),
    "klines": Table(
        f"kline_id bigint, opentime timestamp, openPrice {PRICE}, highPrice {PRICE}, "
        f"lowPrice {PRICE}, closePrice {PRICE}, volume {AMOUNT}, closetime timestamp, "
        f"quoteassetvolume {AMOUNT}, numberoftrades bigint, "
        f"takerbaseassetvolume {AMOUNT}, takerbuyquoteassetvolume {AMOUNT}, symbol string, "
        "open_date date",
        ("open_date",),
        ("symbol", "opentime"),
    ),
    "ticker_24h": Table(
        f"ticker_id bigint, priceChange {PRICE}, priceChangePercent {PRICE}, "
        f"weightedAvgPrice {PRICE}, prevClosePrice {PRICE}, lastPrice {PRICE}, "
        f"bidPrice {PRICE}, askPrice {PRICE}, openPrice {PRICE}, highPrice {PRICE}, "
        f"lowPrice {PRICE}, volume {AMOUNT}, openTime timestamp, closeTime timestamp, "
        "firstTradeId bigint, lastTradeId bigint, count bigint, symbol string, close_date date",
        ("close_date",),
        ("symbol", "ticker_id"),
    ),
    "symbol_dim": Table("symbol_id bigint, symbol string"),
    # Greatest trade id per symbol and load, so that nobody scans all trades for it.
    "trade_watermarks": Table(
        "symbol string, trade_id bigint, load_date date", ("load_date",)
    ),
    **{
        kind.table: Table(
            ", ".join(f"`{name}` {dtype}" for name, dtype in kind.columns.items())
            + ", symbol string, filter_type_id bigint, load_date date",
            ("load_date",),
            ("symbol", "filter_type_id"),
            FILTER_BUCKETS,
        )
        for kind in FILTER_TYPES.values()
    },
}

# What loads note about themselves, so that later ones need not read whole tables.
BOOKS = {
    # A load begins and ends; one that has no end broke off.
    "load_log": Table("load_no bigint, phase string, load_date date, table_name string", ("table_name",)),
    # Greatest id per symbol that a load gave.
    "id_marks": Table("symbol string, latest_id bigint, load_no bigint, table_name string", ("table_name",)),
    # Values that did not fit their type, and rows without a key (column_name is NULL).
    "load_rejects": Table(
        "column_name string, n_rows bigint, n_rejects bigint, table_name string, load_date date",
        ("table_name", "load_date"),
    ),
    # Days whose trades a load may have added to.
    "trade_journal": Table("trade_date date, load_no bigint"),
    # Days whose candles were derived from trades, and the last load they knew of.
    "derived_days": Table("trade_date date, load_no bigint"),
    # Runs of trade ids without a hole, by the day that brought them.
    "trade_id_ranges": Table("symbol string, first_id bigint, last_id bigint, load_date date", ("load_date",)),
}

REPORTS = {
    "number_of_trades_symbols": Table("symbol string, NumberOfTrades bigint"),
    "daily_trade_ledger": Table("NumberOfTrades bigint, day date", ("day",)),
    # The last load that the ledger's count of a day knows of.
    "daily_ledger_loads": Table("load_no bigint, day date", ("day",)),
    "total_trades": Table("TotalTrades bigint"),
}


def create_table_sql(database: str, name: str, table: Table) -> str:
    """Typed, partitioned parquet table as DDL.

    Overwrites of a partitioned table replace the partitions they have rows for,
    which the table itself says, not the session.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    parts = ", ".join(f"`{c}`" for c in table.partitions)
    partitioned = f" OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY ({parts})" if parts else ""
    order = ", ".join(f"`{c}`" for c in table.order)
    clustered = f" CLUSTERED BY ({order}) SORTED BY ({order}) INTO {table.buckets} BUCKETS" if table.buckets else ""
    return f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet{partitioned}{clustered}"
