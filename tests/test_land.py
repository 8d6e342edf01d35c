"""What is landed is kept or counted, and books spare reading whole tables."""

from __future__ import annotations

import json
import random
import uuid
from datetime import date, timedelta

import data
import pytest
from data import T0
from pyspark.sql import functions as F

from candlemill.operators import incremental, keys
from candlemill.plans import books, land, load
from candlemill.sources import lake, landing, warehouse

DAY = date(2024, 1, 15)


@pytest.fixture
def db(spark):
    name = f"l{uuid.uuid4().hex[:8]}"
    warehouse.create_warehouse(spark, name)
    yield name
    for one in (name, f"{name}_reports"):
        spark.sql(f"DROP DATABASE IF EXISTS {one} CASCADE")


def put(root, table, text, symbol="A", name="p.json", day=DAY):
    folder = root / f"{table}/day={day}/symbol={symbol}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def trade(i, **more):
    return {"id": i, "price": "2", "qty": "1", "quoteQty": "2", "time": data.ms(T0)} | more


def candle(i, price="1"):
    start = data.ms(T0) + 60_000 * i
    return [start, price, price, price, price, "1", start + 59_999, "1", 3, "0", "0", "0"]


def test_every_line_is_kept_or_rejected(spark, tmp_path):
    root, lake_root = tmp_path / "landing", str(tmp_path / "lake")
    lines = [
        json.dumps(trade(1)), "", json.dumps([trade(2), trade(3)]), json.dumps([trade(4)])[:-3], "[]", "  ",
        json.dumps([trade(5), trade("x"), trade(None), None]), '"text"', "null", json.dumps(trade(6, time=None)),
        json.dumps(trade(7))[:30], json.dumps(trade(8, unused=[1, {"a": 2}])),
    ]
    put(root, "Trades", "\n".join(lines))
    put(root, "Trades", json.dumps(trade(1)), symbol="B")
    candles = [json.dumps([candle(0), candle(1)]), json.dumps(candle(2)), "[]", json.dumps([candle(3), [1, 2], candle(4)])]
    candles += [json.dumps([candle(5), candle(6)])[:-9], json.dumps([["x", *candle(7)[1:]], [None, *candle(7)[1:]]])]
    put(root, "Klines", "\n".join(candles))
    for _ in range(2):
        land.land_to_lake(spark, str(root), lake_root, DAY)
        kept = lake.read_lake_day(spark, lake_root, "Trades", DAY)
        assert data.rows(kept.select("symbol", "id")) == [("A", i) for i in (1, 2, 3, 5, 8)] + [("B", 1)]
        rejects = land.read_rejects(spark, lake_root).where("table = 'Trades'")
        got = sorted((r.line, r.record, r.reason) for r in rejects.collect())
        assert got == [(4, 0, "broken"), (7, 1, "broken"), (7, 2, "no key"), (7, 3, "broken"),
                       (8, 0, "broken"), (9, 0, "broken"), (10, 0, "no key"), (11, 0, "broken")]
        assert {r.text for r in rejects.where("line = 4").collect()} == {lines[3]}
        kept = lake.read_lake_day(spark, lake_root, "Klines", DAY)
        assert sorted((r._1 - data.ms(T0)) // 60_000 for r in kept.collect()) == [0, 1, 2, 3, 4]
        rejects = land.read_rejects(spark, lake_root).where("table = 'Klines'")
        assert sorted((r.line, r.record, r.reason) for r in rejects.collect()) == [
            (4, 1, "broken"), (5, 0, "broken"), (6, 0, "broken"), (6, 1, "no key")]
        files = {(r.table, r.symbol): (r.n_lines, r.n_rejects) for r in land.read_landed(spark, lake_root).collect()}
        assert files == {("Trades", "A"): (10, 8), ("Trades", "B"): (1, 0), ("Klines", "A"): (6, 4)}
    put(root, "Trades", json.dumps(trade(9)))
    land.land_to_lake(spark, str(root), lake_root, DAY)
    assert land.read_rejects(spark, lake_root).where("table = 'Trades'").isEmpty()


def test_lines_of_files_read_in_blocks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = [json.dumps(trade(i)) if i % 7 else f"broken {i}" for i in range(400)]
    put(tmp_path, "Trades", "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = landing.landed_lines(spark, str(tmp_path), "Trades", DAY)
        assert found.select("block").distinct().count() > 5
        got = landing.rejected(landing.records(found, "Trades"), found).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.line, r.text) for r in got) == [(i + 1, f"broken {i}") for i in range(0, 400, 7)]


def test_a_half_landed_day_is_reported(spark, db, tmp_path):
    root, lake_root = tmp_path / "landing", str(tmp_path / "lake")
    ticker = {"firstId": 1, "lastId": 3, "openTime": data.ms(T0) - 86_400_000, "closeTime": data.ms(T0)}
    for symbol in "AB":
        put(root, "Ticker_24h", json.dumps(ticker), symbol)
        put(root, "SymbolInfor", json.dumps({"status": "TRADING", "filters": []}), symbol)
    put(root, "Ticker_24h", json.dumps(ticker | {"firstId": -1, "lastId": -1}), "NONE")
    put(root, "Trades", json.dumps([trade(i) for i in (1, 2, 3)]))
    land.land_tickers(spark, str(root), lake_root, DAY, db)
    land.land_to_lake(spark, str(root), lake_root, DAY)
    report = {r.table: (r.status, r.n_files, r.n_missing) for r in land.landing_report(spark, lake_root, DAY).collect()}
    assert report == {"Ticker_24h": ("whole", 3, 0), "SymbolInfor": ("whole", 2, 0), "Trades": ("half", 1, 1), "Klines": ("empty", 0, 2)}


def test_missing_ids_equal_plain_sets(spark):
    rng = random.Random(4)
    for _ in range(3):
        loads, tickers, want = [], [], {}
        for symbol in "ABCD":
            ids = {i for i in range(10, 400) if rng.random() < 0.8} if symbol != "D" else set()
            for day in range(2):
                loads += [(symbol, i, str(day)) for i in sorted(ids) if rng.random() < 0.7 or day]
            first, last = rng.randrange(0, 200), rng.randrange(200, 450)
            tickers.append((symbol, first, last))
            low = min([first, *ids])
            want[symbol] = sorted(set(range(low, last + 1)) - ids)
        stored = spark.createDataFrame(loads, "symbol string, trade_id long, day string")
        ranges = incremental.id_ranges(stored.where("day = '0'")).unionByName(incremental.id_ranges(stored.where("day = '1'")))
        pages = incremental.missing_trade_pages(spark.createDataFrame(tickers, "symbol string, firstId long, lastId long"), ranges, 7)
        got: dict[str, list[int]] = {s: [] for s in "ABCD"}
        for r in pages.collect():
            assert r.to_id - r.from_id < 7
            got[r.symbol] += range(r.from_id, r.to_id + 1)
        assert {s: sorted(x) for s, x in got.items()} == want


def test_rejects_of_a_load_are_replaced(spark, db, tmp_path):
    root = str(tmp_path)
    raw = data.raw_trades(spark, [("A", i, "1", "1", T0) for i in range(6)])
    for expression, expected in (("'99999999999'", 3), ("'1'", 0)):
        unfit = raw.withColumn("price", F.when(F.col("id") < 3, F.expr(expression)).otherwise(F.col("price")))
        unfit = unfit.withColumn("id", F.when(F.col("id") != 5, F.col("id")))
        lake.write_lake(unfit, root, "Trades", DAY, replace=True)
        for _ in range(2):
            load.load_trades(spark, root, DAY, db)
        got = {r.column_name: (r.n_rows, r.n_rejects) for r in spark.table(f"{db}.load_rejects").collect()}
        assert got == {None: (6, 1), "price": (6, expected), "qty": (6, 0), "quoteQty": (6, 0)}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_go_on_from_the_marks_and_are_made_anew_after_a_break(spark, db, tmp_path, monkeypatch):
    root = str(tmp_path)

    def klines(n, day):
        lake.write_lake(data.raw_klines(spark, [("A", T0 + timedelta(minutes=i), "1", 1) for i in range(n)]), root, "Klines", day, replace=True)

    klines(3, DAY)
    load.load_klines(spark, root, DAY, db)
    following = books.begin(spark, db, "klines", DAY)
    assert following.follows_end and "klines/" not in plan(following.latest_ids("kline_id")).replace("id_marks", "")
    assert following.latest_ids("kline_id").first().latest_id == 3
    # That load never ends, so the next one reads the candles themselves.
    again = books.begin(spark, db, "klines", DAY)
    assert not again.follows_end and data.rows(again.latest_ids("kline_id")) == [("A", 3)]
    later = DAY + timedelta(days=1)
    klines(5, later)
    monkeypatch.setattr(books, "COMPACT_EVERY", 2)
    for _ in range(3):
        load.load_klines(spark, root, later, db)
    stored = spark.table(f"{db}.klines").orderBy("opentime").collect()
    assert [r.kline_id for r in stored] == [1, 2, 3, 4, 5]
    assert data.rows(keys.latest_ids(books.begin(spark, db, "klines", later).book("id_marks"), "latest_id")) == [("A", 5)]


def test_the_ledger_counts_touched_days_only(spark, db, tmp_path, monkeypatch):
    root, made = str(tmp_path), f"{db}_reports"
    warehouse.create_reports(spark, made)
    days = [T0 - timedelta(days=k) for k in range(5)]
    lake.write_lake(data.raw_trades(spark, [("A", i, "1", "1", days[i % 5]) for i in range(50)]), root, "Trades", DAY)
    load.load_trades(spark, root, DAY, db)
    seen = []
    count = load.reports.daily_ledger
    monkeypatch.setattr(load.reports, "daily_ledger", lambda t: seen.append(t) or count(t))
    assert load.refresh_ledger(spark, T0, db, made).agg(F.sum("NumberOfTrades")).first()[0] == 50
    late = data.raw_trades(spark, [("A", 500, "1", "1", days[3])])
    lake.write_lake(late, root, "Trades", DAY + timedelta(days=1))
    load.load_trades(spark, root, DAY + timedelta(days=1), db)
    ledger = load.refresh_ledger(spark, T0, db, made)
    assert {r.day: r.NumberOfTrades for r in ledger.collect()} == {d.date(): 10 + (k == 3) for k, d in enumerate(days)}
    assert "dynamicpruning" in plan(seen[-1]).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {r.trade_date for r in seen[-1].select("trade_date").distinct().collect()} == {days[3].date()}
    load.refresh_ledger(spark, T0, db, made)
    assert seen[-1].isEmpty()


def test_filter_tables_join_without_a_shuffle(spark, db, tmp_path):
    rules = [{"filterType": "PRICE_FILTER", "maxPrice": "9"}, {"filterType": "ICEBERG_PARTS", "limit": "x"}]
    symbols = data.raw_symbol(spark, [(f"S{i}", 15, rules) for i in range(20)]).drop("year", "month", "day")
    lake.write_lake(symbols, str(tmp_path), "SymbolInfor", DAY)
    for _ in range(2):
        load.load_symbols(spark, str(tmp_path), DAY, db)
    price, parts = spark.table(f"{db}.price_filter_detail"), spark.table(f"{db}.iceberg_parts_filter_detail")
    joined = price.join(parts.hint("merge"), ["symbol", "filter_type_id"])
    assert "Exchange" not in plan(joined) and joined.count() == 20
    # A directory a day, and a file a bucket at most.
    assert {f.split("/")[-2] for f in price.inputFiles()} == {f"load_date={DAY}"} and len(price.inputFiles()) <= 8
    rejects = spark.table(f"{db}.load_rejects").where("n_rejects > 0").collect()
    assert [(r.table_name, r.column_name, r.n_rows, r.n_rejects) for r in rejects] == [("filters", "ICEBERG_PARTS.limit", 40, 20)]
