from __future__ import annotations

from datetime import date, timedelta

import data
import pytest
from data import T0
from pyspark.sql import functions as F

from candlemill import session
from candlemill.operators import derive
from candlemill.operators.clean import clean_trades
from candlemill.sources import lake
from candlemill.streaming import trades as stream

DAY = date(2024, 1, 15)
COUNT = 200


def some_trades(spark, first=0, n=COUNT, start=T0):
    return data.raw_trades(
        spark,
        [("AB"[i % 2], i, str(i % 17 + 1), "2", start + timedelta(seconds=7 * (i - first)), i % 3 == 0)
         for i in range(first, first + n)],
    )


def run(start, *args, **options):
    start(*args, **options).awaitTermination()


def test_trades_once_however_often_they_come(spark, tmp_path):
    root, out, state = (str(tmp_path / n) for n in ("lake", "out", "state"))
    raw = some_trades(spark)
    lake.write_lake(raw, root, "Trades", DAY)
    lake.write_lake(raw, root, "Trades", DAY)
    run(stream.load_new_trades, spark, root, out, state)
    assert stream.stored_trades(spark, out).count() == COUNT
    run(stream.load_new_trades, spark, root, out, state)
    lake.write_lake(raw, root, "Trades", DAY)
    early = some_trades(spark, 5000, 3, T0 - timedelta(days=400))
    lake.write_lake(early, root, "Trades", DAY)
    run(stream.load_new_trades, spark, root, out, state, files_per_batch=1)
    stored = stream.stored_trades(spark, out)
    assert stored.count() == COUNT + 3
    assert stored.select("symbol", "trade_id").distinct().count() == COUNT + 3


def test_a_lost_checkpoint_adds_nothing(spark, tmp_path):
    root, out = str(tmp_path / "lake"), str(tmp_path / "out")
    lake.write_lake(some_trades(spark), root, "Trades", DAY)
    run(stream.load_new_trades, spark, root, out, str(tmp_path / "one"))
    run(stream.load_new_trades, spark, root, out, str(tmp_path / "two"))
    assert stream.stored_trades(spark, out).count() == COUNT


def test_late_trades_change_their_candles(spark, tmp_path):
    root, trades, out = (str(tmp_path / n) for n in ("lake", "trades", "out"))
    states = [str(tmp_path / n) for n in ("trade-state", "kline-state")]
    rows = [("A", i, str(i + 1), "2", T0 + timedelta(hours=7 * (i * 13 % 20)), False) for i in range(20)]

    def load():
        run(stream.load_new_trades, spark, root, trades, states[0], files_per_batch=1)
        run(stream.load_new_klines, spark, trades, out, states[1], files_per_batch=1)

    for part in (rows[:9], rows[9:], rows[:3]):
        lake.write_lake(data.raw_trades(spark, part), root, "Trades", DAY)
        load()
    late = [("A", 100, "99", "1", rows[0][4], False)]
    lake.write_lake(data.raw_trades(spark, late), root, "Trades", DAY)
    load()
    batch = derive.klines_from_trades(clean_trades(data.raw_trades(spark, rows + late)))
    got = stream.stored_klines(spark, out).select(*batch.columns)
    assert data.rows(got) == data.rows(batch)
    assert got.agg({"numberoftrades": "sum"}).first()[0] == 21
    # Each stored trade is in one part, however late it came.
    assert stream.kline_part_rows(spark, out).agg({"numberoftrades": "sum"}).first()[0] == 21
    numbers = [int(n.split("=")[1]) for n in session.folder_names(spark, out)]
    for number in (max(numbers) - 1, max(numbers)):
        stream.compact_klines(spark, out, max(numbers))
        assert session.folder_names(spark, out) == [f"upto={max(numbers)}"]
        assert data.rows(stream.stored_klines(spark, out).select(*batch.columns)) == data.rows(batch)
    with pytest.raises(ValueError):
        stream.load_new_klines(spark, trades, out, str(tmp_path / "other"))


def test_parts_merge_in_any_order(spark):
    rows = [("AB"[i % 2], i, str(i * 37 % 11 + 1), str(i % 5), T0 + timedelta(seconds=i * 7 % 150), i % 3 == 0) for i in range(90)]
    trades = data.trades(spark, rows)
    parts = [derive.kline_parts(trades.where(F.col("trade_id") % 4 == k)) for k in (2, 0, 3, 1)]
    two = derive.merged_parts(parts[0].unionByName(parts[1])).unionByName(derive.merged_parts(parts[2]))
    got = derive.klines_from_parts(two.unionByName(parts[3]))
    want = derive.klines_from_trades(trades)
    assert data.rows(got.select(*want.columns)) == data.rows(want)
