"""Small inline inputs."""

from __future__ import annotations

from datetime import datetime, timezone

from candlemill.schemas import LAKE, WAREHOUSE

T0 = datetime(2024, 1, 15, 12, 0, 0)


def ms(moment: datetime) -> int:
    return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000)


def raw_trades(spark, rows):
    """(symbol, id, price, qty, datetime[, isBuyerMaker]) as raw trades."""
    out = []
    for symbol, tid, price, qty, when, *maker in rows:
        quote = f"{float(price) * float(qty):.10f}"
        out.append((tid, price, qty, quote, ms(when), bool(maker and maker[0]), True, symbol))
    return spark.createDataFrame(out, f"{LAKE['Trades']}, symbol string")


def trades(spark, rows):
    from candlemill.operators.clean import clean_trades

    return clean_trades(raw_trades(spark, rows))


def raw_symbol(spark, rows):
    """(symbol, day, filters[, status]) as raw symbol metadata of January 2024."""
    out = []
    for symbol, day, filters, *status in rows:
        out.append(
            (status[0] if status else "TRADING", "BTC", 8, "USDT", 8, 8, 8, 8)
            + (True,) * 7
            + ("NONE", filters, symbol, 2024, 1, day)
        )
    return spark.createDataFrame(
        out, f"{LAKE['SymbolInfor']}, symbol string, year int, month int, day int"
    )


def raw_klines(spark, rows):
    """(symbol, open datetime, price, trade count) as positional candles."""
    out = []
    for symbol, when, price, n in rows:
        start = ms(when)
        out.append(
            (start, price, price, price, price, "1", start + 59_999, "1", n, "0", "0", "0", symbol)
        )
    return spark.createDataFrame(out, f"{LAKE['Klines']}, symbol string")


def raw_ticker(spark, rows):
    """(symbol, first id, last id, close datetime) as 24-hour statistics."""
    out = []
    for symbol, first, last, when in rows:
        close = ms(when)
        out.append(
            ("1",) * 11 + (close - 86_400_000, close, first, last, last - first, symbol)
        )
    return spark.createDataFrame(out, f"{LAKE['Ticker_24h']}, symbol string")


def empty(spark, table):
    return spark.createDataFrame([], WAREHOUSE[table].schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
