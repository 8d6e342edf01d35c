from __future__ import annotations

import json
from datetime import date, datetime

import data
from data import T0
from pyspark.sql import functions as F

from candlemill.sources import lake, landing

DAY = date(2024, 1, 15)


def write(spark, root, n=6, day=DAY):
    raw = data.raw_trades(spark, [("A1", i, "1.5", "2", T0) for i in range(n)] + [("007", 99, "1", "1", T0)])
    lake.write_lake(raw, root, "Trades", day)
    return raw


def test_layout_and_round_trip(spark, tmp_path):
    root = str(tmp_path)
    raw = write(spark, root, day=date(2024, 7, 5))
    assert list((tmp_path / "Trades/symbol=A1/year=2024/month=07/day=05").glob("*.parquet"))
    back = lake.read_lake(spark, root, "Trades")
    assert data.rows(back.select(*raw.columns)) == data.rows(raw)
    assert {tuple(r) for r in back.select("year", "month", "day").collect()} == {(2024, 7, 5)}
    assert {r.symbol for r in back.collect()} == {"A1", "007"}


def test_slice_by_path_equals_slice_by_filter(spark, tmp_path):
    root = str(tmp_path)
    write(spark, root)
    write(spark, root, day=date(2024, 1, 16))
    by_path = lake.read_lake_day(spark, root, "Trades", DAY, "A1")
    by_filter = lake.lake_slice(lake.read_lake(spark, root, "Trades"), "A1", DAY)
    assert by_path.count() == 6
    assert data.rows(by_path) == data.rows(by_filter)
    plan = by_filter._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    assert data.rows(lake.row_counts(lake.read_lake_day(spark, root, "Trades", DAY))) == [
        ("007", 1),
        ("A1", 6),
    ]


def test_missing_data_gives_no_rows(spark, tmp_path):
    root = str(tmp_path)
    assert lake.read_lake(spark, root, "Klines").count() == 0
    write(spark, root)
    other_day = lake.read_lake_day(spark, root, "Trades", date(2023, 1, 1))
    other_symbol = lake.read_lake_day(spark, root, "Trades", DAY, "NONE")
    assert other_day.count() == other_symbol.count() == 0
    assert other_day.columns == lake.read_lake(spark, root, "Trades").columns


def test_append_keeps_earlier_rows(spark, tmp_path):
    write(spark, str(tmp_path))
    write(spark, str(tmp_path))
    assert lake.read_lake(spark, str(tmp_path), "Trades").count() == 14


def test_a_folder_below_the_day_is_read(spark, tmp_path):
    """Lakes written with one more folder under the day stay readable."""
    raw = data.raw_trades(spark, [("A", 1, "1.5", "2", T0)])
    folder = tmp_path / "Trades/symbol=A/year=2024/month=01/day=15/Trades.parquet"
    raw.drop("symbol").write.parquet(str(folder))
    got = lake.read_lake_day(spark, str(tmp_path), "Trades", DAY)
    assert data.rows(got.select(*raw.columns)) == data.rows(raw)
    assert lake.read_lake(spark, str(tmp_path), "Trades").where("symbol = 'A'").count() == 1


def test_records_that_carry_their_symbol_too(spark, tmp_path):
    raw = data.raw_ticker(spark, [("A", 1, 5, T0)])
    folder = tmp_path / "lake/Ticker_24h/symbol=A/year=2024/month=01/day=15/Ticker_24h.parquet"
    raw.withColumn("lastQty", F.lit("1")).write.parquet(str(folder))
    got = lake.read_lake_day(spark, str(tmp_path / "lake"), "Ticker_24h", DAY)
    assert data.rows(got.select(*raw.columns)) == data.rows(raw)
    landed = tmp_path / f"landing/Ticker_24h/day={DAY}/symbol=A"
    landed.mkdir(parents=True)
    (landed / "t.json").write_text(json.dumps({"symbol": "A", "firstId": 1, "lastPrice": "2"}))
    (row,) = landing.read_landing(spark, str(tmp_path / "landing"), "Ticker_24h", DAY).collect()
    assert (row.symbol, row.firstId, row.lastPrice) == ("A", 1, "2")


def test_landed_records_and_pages(spark, tmp_path):
    one = {"id": 1, "price": "2.50", "qty": "1", "quoteQty": "2.5", "time": data.ms(T0),
           "isBuyerMaker": True, "isBestMatch": True, "unused": 5}
    trades = tmp_path / f"Trades/day={DAY}/symbol=A"
    trades.mkdir(parents=True)
    (trades / "page.json").write_text(json.dumps([one, {**one, "id": 2}]) + "\n" + json.dumps({**one, "id": 3}))
    got = landing.read_landing(spark, str(tmp_path), "Trades", DAY)
    assert data.rows(got.select("symbol", "id", "price")) == [("A", i, "2.50") for i in (1, 2, 3)]

    klines = tmp_path / f"Klines/day={DAY}/symbol=A"
    klines.mkdir(parents=True)
    candle = [data.ms(T0), "1", "2", "0.5", "1.5", "10", data.ms(T0) + 59_999, "15", 4, "3", "4", "0"]
    (klines / "page.json").write_text(json.dumps([candle, candle]))
    got = landing.read_landing(spark, str(tmp_path), "Klines", DAY).collect()
    assert len(got) == 2
    assert (got[0]._1, got[0]._3, got[0]._9, got[0].symbol) == (data.ms(T0), "2", 4, "A")


def test_filters_of_mixed_types_become_text(spark, tmp_path):
    folder = tmp_path / f"SymbolInfor/day={DAY}/symbol=A"
    folder.mkdir(parents=True)
    rule = {"filterType": "ICEBERG_PARTS", "limit": 10, "on": True, "step": "0.10"}
    (folder / "r.json").write_text(json.dumps({"status": "TRADING", "filters": [rule]}))
    (row,) = landing.read_landing(spark, str(tmp_path), "SymbolInfor", DAY).collect()
    assert row.filters == [
        {"filterType": "ICEBERG_PARTS", "limit": "10", "on": "true", "step": "0.10"}
    ]


def test_page_of_objects_parses_in_place(spark):
    text = '[{"id": 1, "price": "2"}, {"id": 2}]'
    df = spark.createDataFrame([(text,)], "t string")
    page = df.select(F.explode(landing.parse_page(F.col("t"), "Trades")).alias("r"))
    assert [r.id for r in page.select("r.*").collect()] == [1, 2]


def test_days_come_from_the_argument(spark, tmp_path):
    raw = data.raw_trades(spark, [("A", 1, "1", "1", datetime(2020, 2, 2))])
    lake.write_lake(raw, str(tmp_path), "Trades", F.to_date(F.timestamp_millis("time")))
    assert lake.read_lake_day(spark, str(tmp_path), "Trades", date(2020, 2, 2)).count() == 1


def test_symbols_that_paths_escape_are_found(spark, tmp_path):
    root = str(tmp_path)
    names = ["A/B", "A:C", "X[1]", "Y*", "Z=1"]
    raw = data.raw_trades(spark, [(s, i, "1", "1", T0) for i, s in enumerate(names)])
    lake.write_lake(raw, root, "Trades", DAY)
    for name in names:
        assert [r.symbol for r in lake.read_lake_day(spark, root, "Trades", DAY, name).collect()] == [name]


def symbols_of(rows):
    return {r.symbol: r.status for r in rows.collect()}


def test_metadata_has_no_directory_per_symbol(spark, tmp_path):
    root, later = str(tmp_path), date(2024, 1, 16)
    rules = [{"filterType": "ICEBERG_PARTS", "limit": "10"}]
    raw = data.raw_symbol(spark, [(f"S{i:03}", 15, rules) for i in range(300)] + [("A/B", 15, []), ("007", 15, None)])
    raw = raw.drop("year", "month", "day")
    for day in (DAY, later):
        lake.write_lake(raw, root, "SymbolInfor", day)
    lake.write_lake(raw.where("symbol = '007'"), root, "SymbolInfor", DAY)
    folders = {f.parent for f in tmp_path.glob("SymbolInfor/**/*.parquet")}
    assert folders == {tmp_path / f"SymbolInfor/year=2024/month=01/day={d}" for d in (15, 16)}
    back = lake.read_lake_day(spark, root, "SymbolInfor", DAY)
    assert data.rows(back.select(*raw.columns)) == data.rows(raw.unionByName(raw.where("symbol = '007'")))
    assert {tuple(r) for r in back.select("year", "month", "day").collect()} == {(2024, 1, 15)}
    assert lake.read_lake_day(spark, root, "SymbolInfor", later, "A/B").count() == 1
    assert lake.read_lake(spark, root, "SymbolInfor").count() == 605
    assert back.columns == lake.read_lake(spark, root, "SymbolInfor").columns == lake.lake_schema("SymbolInfor").names


def test_metadata_of_a_day_is_replaced_by_symbol(spark, tmp_path):
    root, later = str(tmp_path), date(2024, 1, 16)

    def put(rows, day, replace=True):
        raw = data.raw_symbol(spark, [(s, 1, [], status) for s, status in rows])
        lake.write_lake(raw.drop("year", "month", "day"), root, "SymbolInfor", day, replace)

    put([("A", "1"), ("B", "1"), (None, "1")], DAY)
    put([("A", "1")], later)
    for _ in range(2):
        put([("B", "2"), ("C", "2"), ("", "2")], DAY)
    got = data.rows(lake.read_lake_day(spark, root, "SymbolInfor", DAY).select("symbol", "status"))
    assert got == sorted([("A", "1"), ("B", "2"), ("C", "2"), (None, "2")], key=repr)
    assert symbols_of(lake.read_lake_day(spark, root, "SymbolInfor", later)) == {"A": "1"}
    # Under a date column, too.
    day = F.when(F.col("symbol") == "A", F.lit(later)).otherwise(F.lit(DAY))
    put([("A", "3"), ("B", "3")], day)
    assert symbols_of(lake.read_lake_day(spark, root, "SymbolInfor", DAY)) == {"A": "1", "B": "3", "C": "2", None: "2"}
    assert symbols_of(lake.read_lake_day(spark, root, "SymbolInfor", later)) == {"A": "3"}


def test_a_lake_by_symbol_stays_so(spark, tmp_path):
    root = str(tmp_path)
    raw = data.raw_symbol(spark, [("A", 15, [], "1"), ("B", 15, [], "1")]).drop("year", "month", "day")
    for symbol in "AB":
        folder = tmp_path / f"SymbolInfor/symbol={symbol}/year=2024/month=01/day=15/SymbolInfor.parquet"
        raw.where(F.col("symbol") == symbol).drop("symbol").write.parquet(str(folder))
    lake.write_lake(raw.withColumn("symbol", F.lit("C")).limit(1), root, "SymbolInfor", DAY)
    lake.write_lake(raw.where("symbol = 'A'").withColumn("status", F.lit("2")), root, "SymbolInfor", DAY, replace=True)
    assert symbols_of(lake.read_lake_day(spark, root, "SymbolInfor", DAY)) == {"A": "2", "B": "1", "C": "1"}
    assert symbols_of(lake.read_lake(spark, root, "SymbolInfor")) == {"A": "2", "B": "1", "C": "1"}
    assert not list(tmp_path.glob("SymbolInfor/year=*"))
