from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

import data
import pytest
from data import T0

from candlemill.operators import derive

DAY = timedelta(days=1)


def random_trades(seed=3, n=600):
    rng = random.Random(seed)
    return [
        (
            rng.choice("AAB"),
            tid,
            str(rng.randrange(1, 500)),
            str(rng.randrange(1, 9)),
            T0 - timedelta(seconds=rng.randrange(0, 4 * 86400)),
            rng.random() < 0.5,
        )
        for tid in rng.sample(range(10**12), n)
    ]


def test_candles_equal_brute_force(spark):
    source = random_trades()
    groups = defaultdict(list)
    for s, tid, p, q, when, maker in source:
        groups[(s, when.replace(second=0))].append((when, tid, Decimal(p), Decimal(q), maker))
    got = derive.klines_from_trades(data.trades(spark, source)).collect()
    assert len(got) == len(groups)
    for k in got:
        g = sorted(groups[(k.symbol, k.opentime)])
        prices = [x[2] for x in g]
        assert (k.openPrice, k.closePrice) == (prices[0], prices[-1])
        assert (k.highPrice, k.lowPrice) == (max(prices), min(prices))
        assert k.volume == sum(x[3] for x in g) and k.numberoftrades == len(g)
        assert k.quoteassetvolume == sum(x[2] * x[3] for x in g)
        assert k.takerbaseassetvolume == sum(x[3] for x in g if not x[4])


def test_tie_in_one_second_is_broken_by_id(spark):
    t = data.trades(spark, [("A", 9, "3", "1", T0), ("A", 5, "1", "1", T0), ("A", 7, "2", "1", T0)])
    k = derive.klines_from_trades(t).collect()[0]
    assert (k.openPrice, k.closePrice) == (1, 3)
    assert derive.last_prices(t).collect()[0].prevClosePrice == 3


def test_any_id_orders_trades(spark):
    big = 1 << 62
    t = data.trades(spark, [("A", big + 1, "3", "1", T0), ("A", big, "1", "1", T0), ("A", 5, "2", "1", T0)])
    k = derive.klines_from_trades(t).collect()[0]
    assert (k.openPrice, k.closePrice) == (2, 3)
    assert derive.last_prices(t).collect()[0].prevClosePrice == 3


def test_last_closes_need_a_whole_minute(spark):
    with pytest.raises(ValueError, match="whole minutes"):
        derive.last_closes(derive.klines_from_trades(data.trades(spark, [])), T0 + timedelta(seconds=30))


def test_ticker_equals_brute_force(spark):
    source = random_trades(seed=5)
    t = data.trades(spark, source)
    got = {r.symbol: r for r in derive.ticker_from_trades(t, T0).collect()}
    for symbol in "AB":
        mine = sorted((w, i, Decimal(p), Decimal(q)) for s, i, p, q, w, _ in source if s == symbol)
        day = [x for x in mine if x[0] >= T0 - DAY]
        before = [x for x in mine if x[0] < T0 - DAY]
        r = got[symbol]
        assert (r.openPrice, r.lastPrice) == (day[0][2], day[-1][2])
        assert r.priceChange == day[-1][2] - day[0][2]
        assert r.prevClosePrice == before[-1][2]
        assert (r.firstId, r.lastId) == (min(x[1] for x in day), max(x[1] for x in day))
        assert r["count"] == len(day)
        weighted = sum(x[2] * x[3] for x in day) / sum(x[3] for x in day)
        assert abs(r.weightedAvgPrice - weighted) < Decimal("0.0000001")


def test_previous_close_from_candles_is_the_same(spark):
    t = data.trades(spark, random_trades(seed=9))
    closes = derive.last_closes(derive.klines_from_trades(t), T0 - DAY)
    a = derive.ticker_from_trades(t, T0)
    b = derive.ticker_from_trades(t, T0, closes)
    assert data.rows(a) == data.rows(b)


def test_zero_volume_has_no_weighted_price(spark):
    t = data.trades(spark, [("A", 1, "3", "0", T0)])
    r = derive.ticker_from_trades(t, T0).collect()[0]
    assert r.weightedAvgPrice is None and r.prevClosePrice is None and r.volume == 0


def test_candle_volumes_sum_to_trade_volumes(spark):
    t = data.trades(spark, random_trades(seed=11))
    per_candle = derive.klines_from_trades(t).agg({"volume": "sum", "numberoftrades": "sum"})
    per_trade = t.agg({"qty": "sum", "trade_id": "count"})
    assert set(per_candle.collect()[0]) == set(per_trade.collect()[0])


def test_ratio_is_exact_and_rounded_half_up(spark):
    rows = [("2", "3"), ("-2", "3"), ("1", "0"), ("200000000000000000000", "100000000000000")]
    df = spark.createDataFrame(rows, "n string, d string").selectExpr(
        "CAST(n AS DECIMAL(38,10)) AS n", "CAST(d AS DECIMAL(38,10)) AS d"
    )
    got = [r[0] for r in df.select(derive.ratio(df.n, df.d)).collect()]
    assert got == [Decimal("0.6666666667"), Decimal("-0.6666666667"), None, Decimal(2_000_000)]
