from __future__ import annotations

from datetime import timedelta

import data
from data import T0

from candlemill.plans import reports

SECOND = timedelta(seconds=1)
DAY = timedelta(days=1)


def test_both_bounds_are_included(spark):
    times = [T0 - DAY - SECOND, T0 - DAY, T0, T0 + SECOND]
    t = data.trades(spark, [("A", i, "1", "1", w) for i, w in enumerate(times)])
    assert data.rows(reports.daily_trade_counts(t, T0)) == [("A", 2)]
    series = reports.symbol_trades(t, "A", T0).collect()
    assert [r.trade_id for r in series] == [1, 2]


def test_every_trade_counts_once(spark):
    assert data.rows(reports.total_trades(reports.daily_ledger(data.trades(spark, [])), data.trades(spark, []), T0)) == [(0,)]
    # One exactly a day before the report, one at its time, one after it.
    times = [T0 - 3 * DAY, T0 - DAY, T0, T0 + SECOND]
    t = data.trades(spark, [("A", i, "1", "1", w) for i, w in enumerate(times)])
    for as_of, count in ((T0, 3), (T0 - DAY, 2), (T0 - DAY - SECOND, 1), (T0 + 5 * SECOND, 4), (T0 + DAY, 4)):
        assert data.rows(reports.total_trades(reports.daily_ledger(t), t, as_of)) == [(count,)]


def test_running_totals(spark):
    t = data.trades(spark, [("A", i, "1", "1", T0 - (i % 3) * DAY) for i in range(7)])
    got = [r.TotalTrades for r in reports.running_totals(reports.daily_ledger(t)).orderBy("day").collect()]
    assert got == [2, 4, 7]


def test_all_symbols_at_once_equals_one_by_one(spark):
    t = data.trades(spark, [(s, i, "1", "1", T0) for i, s in enumerate("AABBBC")])
    whole = data.rows(reports.daily_trade_counts(t, T0))
    single = [r for s in "ABC" for r in data.rows(reports.daily_trade_counts(t.where(t.symbol == s), T0))]
    assert whole == single
