from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

import data
import pytest
from data import T0

from candlemill.plans import load
from candlemill.schemas import BOOKS, REPORTS, WAREHOUSE
from candlemill.sources import lake, warehouse

DAY = date(2024, 1, 15)
MINUTE = timedelta(minutes=1)


@pytest.fixture
def db(spark):
    name = f"w{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"DROP DATABASE IF EXISTS {name}_reports CASCADE")


def fill_lake(spark, root, day=DAY, first_id=1, when=T0):
    trades = [("BTC", first_id + i, str(10 + i), "1", when - i * MINUTE) for i in range(8)]
    trades += [("ETH", first_id + i, "5", "2", when - i * MINUTE) for i in range(3)]
    lake.write_lake(data.raw_trades(spark, trades), root, "Trades", day)
    klines = [(s, when - i * MINUTE, str(i + 1), i) for s in ("BTC", "ETH") for i in range(4)]
    lake.write_lake(data.raw_klines(spark, klines), root, "Klines", day)
    ticker = [(s, first_id, first_id + 7, when) for s in ("BTC", "ETH")]
    lake.write_lake(data.raw_ticker(spark, ticker), root, "Ticker_24h", day)
    rules = [
        {"filterType": "PRICE_FILTER", "maxPrice": "9", "minPrice": "1", "tickSize": "0.01"},
        {"filterType": "MAX_NUM_ORDERS", "maxNumOrders": "200"},
    ]
    symbols = data.raw_symbol(spark, [(s, day.day, rules) for s in ("BTC", "ETH")])
    lake.write_lake(symbols.drop("year", "month", "day"), root, "SymbolInfor", day)


def contents(spark, db):
    return {n: data.rows(spark.table(f"{db}.{n}").select(*sorted(spark.table(f"{db}.{n}").columns)))
            for n in WAREHOUSE}


def test_all_tables_are_created_typed_and_partitioned(spark, db):
    warehouse.create_warehouse(spark, db)
    warehouse.create_warehouse(spark, db)
    tables = {t.name for t in spark.catalog.listTables(db)}
    assert tables == set(WAREHOUSE) | set(BOOKS) and len(WAREHOUSE) == 15
    for name, table in (WAREHOUSE | BOOKS).items():
        stored = {f.name: f.dataType for f in spark.table(f"{db}.{name}").schema}
        assert stored == {f.name: f.dataType for f in table.schema}
        parts = [c.name for c in spark.catalog.listColumns(f"{db}.{name}") if c.isPartition]
        assert tuple(parts) == table.partitions
    warehouse.use_database(spark, db)
    assert spark.catalog.currentDatabase() == db
    warehouse.use_database(spark, "default")


def test_daily_run_and_its_repetition(spark, db, tmp_path):
    root = str(tmp_path)
    fill_lake(spark, root)
    load.run_day(spark, root, T0, "BTC", db, f"{db}_reports")
    first = contents(spark, db)
    assert len(first["trades"]) == 11 and len(first["klines"]) == 8
    assert len(first["ticker_24h"]) == len(first["symbol_infor"]) == len(first["symbol_dim"]) == 2
    assert len(first["price_filter_detail"]) == len(first["max_num_orders_filter_detail"]) == 2
    ids = spark.table(f"{db}.klines").where("symbol = 'BTC'").orderBy("opentime").collect()
    assert [r.kline_id for r in ids] == [1, 2, 3, 4]

    reports = {
        "number_of_trades_symbols": [("BTC", 8), ("ETH", 3)],
        "total_trades": [(11,)],
    }
    for name, expected in reports.items():
        assert data.rows(spark.table(f"{db}_reports.{name}")) == expected
    assert spark.table(f"{db}_reports.BTC_trades").count() == 8
    assert spark.table(f"{db}_reports.BTC_klines").count() == 4

    load.run_day(spark, root, T0, "BTC", db, f"{db}_reports")
    assert contents(spark, db) == first
    assert data.rows(spark.table(f"{db}_reports.total_trades")) == [(11,)]


def test_a_fuller_candle_replaces_the_stored_one(spark, db, tmp_path):
    root = str(tmp_path)
    fill_lake(spark, root)
    load.run_day(spark, root, T0, "BTC", db, f"{db}_reports")
    before = {(r.symbol, r.opentime): r for r in spark.table(f"{db}.klines").collect()}
    later = DAY + timedelta(days=1)
    pages = [("BTC", T0, "9", 50), ("BTC", T0 - MINUTE, "9", 0), ("BTC", T0 + MINUTE, "9", 1)]
    lake.write_lake(data.raw_klines(spark, pages), root, "Klines", later)
    for _ in range(2):
        load.load_klines(spark, root, later, db)
        after = {(r.symbol, r.opentime): r for r in spark.table(f"{db}.klines").collect()}
        assert spark.table(f"{db}.klines").count() == len(after) == 9
        changed = [k for k in after if before.get(k) != after[k]]
        assert sorted(k[1] for k in changed) == [T0, T0 + MINUTE]
        assert after["BTC", T0].numberoftrades == 50
        assert after["BTC", T0].kline_id == before["BTC", T0].kline_id == 4
        assert after["BTC", T0 + MINUTE].kline_id == 5


def test_a_day_without_data_changes_nothing(spark, db, tmp_path):
    root = str(tmp_path)
    load.run_day(spark, root, T0, "BTC", db, f"{db}_reports")
    assert all(not rows for rows in contents(spark, db).values())
    assert data.rows(spark.table(f"{db}_reports.total_trades")) == [(0,)]
    assert spark.table(f"{db}_reports.number_of_trades_symbols").count() == 0


def test_second_day_continues_ids_and_totals(spark, db, tmp_path):
    root = str(tmp_path)
    fill_lake(spark, root)
    load.run_day(spark, root, T0, "BTC", db, f"{db}_reports")
    later = T0 + timedelta(days=2)
    fill_lake(spark, root, later.date(), first_id=100, when=later)
    load.run_day(spark, root, later, "BTC", db, f"{db}_reports")
    ids = [r.kline_id for r in spark.table(f"{db}.klines").where("symbol = 'BTC'").orderBy("opentime").collect()]
    assert ids == list(range(1, 9))
    assert data.rows(spark.table(f"{db}.ticker_24h").select("symbol", "ticker_id")) == [
        ("BTC", 1), ("BTC", 2), ("ETH", 1), ("ETH", 2),
    ]
    versions = spark.table(f"{db}.symbol_infor").where("symbol = 'ETH'").select("filterstype_id")
    assert data.rows(versions) == [(1,), (2,)]
    detail = spark.table(f"{db}.price_filter_detail").select("symbol", "filter_type_id")
    assert data.rows(detail) == [("BTC", 1), ("BTC", 2), ("ETH", 1), ("ETH", 2)]
    assert spark.table(f"{db}.symbol_dim").count() == 2
    assert data.rows(spark.table(f"{db}_reports.total_trades")) == [(22,)]
    assert spark.table(f"{db}_reports.daily_trade_ledger").count() == 2


def test_a_run_that_broke_off_can_be_repeated(spark, db, tmp_path, monkeypatch):
    root = str(tmp_path)
    fill_lake(spark, root)
    warehouse.create_warehouse(spark, db)
    append = warehouse.append

    def fail_at_the_end(df, database, name):
        if name == "symbol_infor":
            raise RuntimeError("lost")
        append(df, database, name)

    monkeypatch.setattr(warehouse, "append", fail_at_the_end)
    with pytest.raises(RuntimeError):
        load.load_symbols(spark, root, DAY, db)
    monkeypatch.setattr(warehouse, "append", append)
    load.load_symbols(spark, root, DAY, db)
    assert spark.table(f"{db}.price_filter_detail").count() == 2
    assert spark.table(f"{db}.symbol_dim").count() == 2


def test_landing_to_lake(spark, tmp_path):
    one = {"id": 1, "price": "2", "qty": "1", "quoteQty": "2", "time": data.ms(T0)}
    later = DAY + timedelta(days=1)
    for day, records in ((DAY, [one, {**one, "id": 2}]), (later, [{**one, "id": 3}])):
        folder = tmp_path / f"landing/Trades/day={day}/symbol=BTC"
        folder.mkdir(parents=True)
        (folder / "p.json").write_text(json.dumps(records))
    for day in (DAY, DAY, later, DAY):
        load.land_to_lake(spark, str(tmp_path / "landing"), str(tmp_path / "lake"), day, ("Trades",))
    for day, ids in ((DAY, [(1,), (2,)]), (later, [(3,)])):
        rows = lake.read_lake_day(spark, str(tmp_path / "lake"), "Trades", day, "BTC")
        assert data.rows(rows.select("id")) == ids


def test_tickers_resume_and_give_the_fetch_plan(spark, db, tmp_path):
    root, landed = str(tmp_path / "lake"), tmp_path / "landing/Ticker_24h/day=2024-01-16"
    fill_lake(spark, root)
    warehouse.create_warehouse(spark, db)
    load.load_trades(spark, root, DAY, db)
    load.load_trades(spark, root, DAY, db)
    assert data.rows(load.trade_watermarks(spark, db)) == [("BTC", 8), ("ETH", 3)]
    ticker = {"firstId": 1, "lastId": 2500, "count": 2500,
              "openTime": data.ms(T0) - 86_400_000, "closeTime": data.ms(T0)}
    for symbol in ("BTC", "NEW"):
        (landed / f"symbol={symbol}").mkdir(parents=True)
        (landed / f"symbol={symbol}/t.json").write_text(json.dumps(ticker))
    for _ in range(2):
        pages, spans = load.land_tickers(spark, str(tmp_path / "landing"), root, date(2024, 1, 16), db)
    assert sorted(data.rows(pages)) == [
        ("BTC", 9, 1008), ("BTC", 1009, 2008), ("BTC", 2009, 2500),
        ("NEW", 1, 1000), ("NEW", 1001, 2000), ("NEW", 2001, 2500),
    ]
    assert spans.count() == 6
    stored = lake.read_lake_day(spark, root, "Ticker_24h", date(2024, 1, 16))
    assert data.rows(stored.select("symbol", "firstId", "count")) == [
        ("BTC", 9, 2491), ("NEW", 1, 2499),
    ]


def test_insert_into_one_partition(spark, db):
    warehouse.create_warehouse(spark, db)
    rows = spark.createDataFrame([("9", "1", "0.1")], "maxPrice string, minPrice string, tickSize string")
    typed = rows.selectExpr(*(f"CAST({c} AS DECIMAL(20,10)) AS {c}" for c in reversed(rows.columns)), "\"O'X\" AS symbol", "3L AS filter_type_id")
    target = f"{db}.price_filter_detail"
    warehouse.insert_partition(typed, target, {"load_date": "2024-01-15"})
    (row,) = spark.table(target).collect()
    assert (row.symbol, row.filter_type_id, int(row.maxPrice), row.load_date) == ("O'X", 3, 9, DAY)


def test_only_the_given_partitions_are_replaced(spark, db):
    warehouse.create_reports(spark, db)
    ledger = f"{db}.daily_trade_ledger"
    rows = [(5, date(2024, 1, 1)), (6, date(2024, 1, 2))]
    schema = REPORTS["daily_trade_ledger"].schema
    warehouse.overwrite_partitions(spark.createDataFrame(rows, schema), ledger)
    warehouse.overwrite_partitions(spark.createDataFrame([(7, rows[1][1])], schema), ledger)
    assert data.rows(spark.table(ledger)) == [(5, rows[0][1]), (7, rows[1][1])]


def test_report_scan_prunes_symbol_and_day(spark, db, tmp_path):
    from candlemill.plans import reports

    root = str(tmp_path)
    fill_lake(spark, root)
    warehouse.create_warehouse(spark, db)
    load.load_trades(spark, root, DAY, db)
    df = reports.symbol_trades(spark.table(f"{db}.trades"), "BTC", T0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    pushed = filters[filters.index("PushedFilters"):].split("ReadSchema")[0]
    assert "symbol" in filters.split("PushedFilters")[0]
    assert "trade_date" in filters.split("PushedFilters")[0]
    assert "GreaterThanOrEqual(trade_time" in pushed
