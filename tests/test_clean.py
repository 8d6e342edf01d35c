from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import data
from data import T0, ms

from candlemill.functions import times, values
from candlemill.operators import clean
from candlemill.schemas import AMOUNT, LAKE, PRICE


def one(df):
    (row,) = df.collect()
    return row


def test_time_is_truncated_not_rounded(spark):
    df = spark.createDataFrame([(ms(T0) + 999,), (-1,)], "ms bigint")
    got = [r[0] for r in df.select(times.epoch_ms_to_text(df.ms)).collect()]
    assert got == ["2024-01-15 12:00:00", "1969-12-31 23:59:59"]


def test_smallest_decimal_is_exact(spark):
    row = one(data.trades(spark, [("A", 1, "0.00000001", "1", T0)]))
    assert row.price == Decimal("0.00000001")


def test_too_large_or_broken_price_is_null_and_counted(spark):
    raw = data.raw_trades(
        spark, [("A", 1, "10000000000", "1", T0), ("A", 2, "1", "10000000000", T0)]
    )
    got = {r.trade_id: r for r in clean.clean_trades(raw).collect()}
    assert got[1].price is None and got[2].price == 1
    assert got[2].qty == 10_000_000_000
    rejects = one(values.count_rejects(raw, {"price": PRICE, "qty": AMOUNT}, ["symbol"]))
    assert (rejects.rows, rejects.price_rejects, rejects.qty_rejects) == (2, 1, 0)


def test_missing_text_is_not_a_reject(spark):
    raw = spark.createDataFrame([("A", None), ("A", "x")], "symbol string, price string")
    assert one(values.count_rejects(raw, {"price": PRICE}, ["symbol"])).price_rejects == 1


def test_klines_by_position(spark):
    row = one(clean.clean_klines(data.raw_klines(spark, [("A", T0, "2.5", 7)])))
    assert row.opentime == T0 and row.closetime == datetime(2024, 1, 15, 12, 0, 59)
    assert (row.openPrice, row.numberoftrades) == (Decimal("2.5"), 7)
    assert "ignored" not in row.asDict()


def test_ticker_renames(spark):
    row = one(clean.clean_ticker(data.raw_ticker(spark, [("A", 5, 9, T0)])))
    assert (row.firstTradeId, row.lastTradeId, row["count"]) == (5, 9, 4)
    assert row.closeTime == T0


def test_lake_schemas_cover_all_tables():
    assert set(LAKE) == {"SymbolInfor", "Trades", "Klines", "Ticker_24h"}


def test_report_bounds_at_month_and_year_start():
    assert times.report_bounds(datetime(2024, 3, 1, 8)) == (
        datetime(2024, 2, 29, 8),
        datetime(2024, 3, 1, 8),
    )
    assert times.report_bounds(datetime(2024, 1, 1))[0] == datetime(2023, 12, 31)


def test_date_parts_are_zero_padded(spark):
    df = spark.createDataFrame([("2024-07-05 01:02:03",)], "t string")
    parts = times.lake_date_parts(df.t.cast("timestamp"))
    assert tuple(one(df.select(*parts.values()))) == ("2024", "07", "05")
    assert tuple(one(df.select(*times.text_date_parts(df.t).values()))) == ("2024", "07", "05")
