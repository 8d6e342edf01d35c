from __future__ import annotations

from datetime import timedelta

import data
from data import T0, ms

from candlemill.operators import clean, incremental

SECOND = timedelta(seconds=1)


def latest(spark, rows):
    return spark.createDataFrame(rows, "symbol string, latest_id bigint")


def test_watermark_defaults_to_everything(spark):
    t = data.trades(spark, [("A", i, "1", "1", T0) for i in range(4)] + [("B", 0, "1", "1", T0)])
    got = incremental.after_watermark(t, latest(spark, [("A", 1)])).select("symbol", "trade_id")
    assert data.rows(got) == [("A", 2), ("A", 3), ("B", 0)]


def test_ticker_resumes_behind_the_watermark(spark):
    tickers = data.raw_ticker(spark, [(s, 10, 20, T0) for s in "ABCD"])
    marks = latest(spark, [("A", 14), ("B", 30), ("C", 0)])
    got = incremental.resume_tickers(tickers, marks)
    assert data.rows(got.select("symbol", "firstId", "count", "count_inclusive")) == [
        ("A", 15, 5, 6),
        ("B", 31, -11, 0),
        ("C", 10, 10, 11),
        ("D", 10, 10, 11),
    ]


def test_valid_tickers_need_both_ids(spark):
    tickers = data.raw_ticker(
        spark, [("A", 0, 5, T0), ("B", -1, -1, T0), ("C", 1, 1, T0), ("D", 1, 0, T0)]
    )
    assert data.rows(incremental.valid_tickers(tickers).select("symbol")) == [("C",)]


def test_trade_pages_cover_each_id_once(spark, monkeypatch):
    monkeypatch.setattr(incremental, "PAGES_PER_BLOCK", 3)
    spans = [("A", 1, 10_500), ("E", 0, 1500), ("B", 7, 7), ("C", 5, 3), ("D", 1000, 4000)]
    plan = incremental.trade_fetch_plan(data.raw_ticker(spark, [(*s, T0) for s in spans]))
    expect = [
        (symbol, start, min(start + 999, last))
        for symbol, first, last in spans
        for start in range(first, last + 1, 1000)
    ]
    assert data.rows(plan) == sorted(expect, key=repr)


def test_kline_pages_are_twelve_hours(spark):
    plan = incremental.kline_fetch_plan(data.raw_ticker(spark, [("A", 1, 2, T0)]))
    start, half = ms(T0) - 86_400_000, 43_200_000
    assert data.rows(plan) == [
        ("A", start, start + half - 1),
        ("A", start + half, start + 2 * half - 1),
        ("A", start + 2 * half, start + 2 * half),
    ]


def test_same_batch_twice_adds_nothing(spark):
    batch = data.trades(spark, [("A", i, "1", "1", T0 + i * SECOND) for i in range(5)])
    none = data.empty(spark, "trades")
    stored = incremental.new_trades(batch, none)
    assert stored.count() == 5
    assert incremental.new_trades(batch, stored.select(none.columns)).count() == 0
    assert incremental.new_trades(batch.unionByName(batch), none).count() == 5
    assert incremental.new_trades(none, batch).count() == 0


def test_overlapping_candle_pages_keep_the_fuller_one(spark):
    pages = [("A", T0, "1", 3), ("A", T0, "2", 8), ("A", T0 + 60 * SECOND, "1", 1)]
    batch = clean.clean_klines(data.raw_klines(spark, pages))
    got = incremental.new_klines(batch, batch.limit(0))
    assert got.columns == batch.columns
    assert data.rows(got.select("opentime", "numberoftrades")) == [
        (T0, 8),
        (T0 + 60 * SECOND, 1),
    ]
    assert incremental.new_klines(batch, got).count() == 0
    assert incremental.new_klines(batch.limit(0), got).count() == 0


def test_pages_keep_duplicates(spark):
    page = data.trades(spark, [("A", 1, "1", "1", T0)])
    assert incremental.concat_pages([page, page, page]).count() == 3
