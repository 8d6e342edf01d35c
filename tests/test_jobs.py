"""The command-line jobs, in the running session."""

from __future__ import annotations

import json
import uuid

import data
from data import T0

from candlemill.__main__ import main, parser


def test_land_load_report_stream(spark, tmp_path):
    db = f"j{uuid.uuid4().hex[:8]}"
    landed = tmp_path / "landing"
    for table in ("SymbolInfor", "Trades", "Klines", "Ticker_24h"):
        (landed / table / f"day={T0.date()}/symbol=BTC").mkdir(parents=True)

    def land(table, value):
        (landed / table / f"day={T0.date()}/symbol=BTC/r.json").write_text(json.dumps(value))

    land("SymbolInfor", {"status": "TRADING", "filters": [{"filterType": "ICEBERG_PARTS", "limit": 10}]})
    land("Trades", [{"id": i, "price": "2", "qty": "1", "quoteQty": "2", "time": data.ms(T0) - i,
                     "isBuyerMaker": False, "isBestMatch": True} for i in range(1, 5)])
    land("Klines", [[data.ms(T0) - 60_000, "1", "2", "1", "2", "9", data.ms(T0) - 1, "18", 3, "1", "2", "0"]])
    land("Ticker_24h", {"firstId": 1, "lastId": 4, "count": 4, "lastPrice": "2",
                        "openTime": data.ms(T0) - 86_400_000, "closeTime": data.ms(T0)})

    as_of = ["--as-of", str(T0)]
    lake = ["--lake", str(tmp_path / "lake")]
    source = ["--landing", str(landed)]
    names = ["--database", db, "--reports", f"{db}_reports"]
    try:
        main(["plan-fetch", *source, *lake, *as_of, "--out", str(tmp_path / "fetch"), *names])
        main(["land", *source, *lake, *as_of])
        main(["load", *lake, *as_of, *names])
        main(["report", *as_of, "--symbol", "BTC", *names])
        assert data.rows(spark.table(f"{db}_reports.total_trades")) == [(4,)]
        assert spark.table(f"{db}.iceberg_parts_filter_detail").collect()[0].limit == 10
        assert spark.table(f"{db}.ticker_24h").count() == spark.table(f"{db}.klines").count() == 1
        assert data.rows(spark.read.parquet(str(tmp_path / "fetch/trades"))) == [("BTC", 1, 4)]
        out = {n: str(tmp_path / n) for n in ("trades", "klines", "state")}
        main(["stream", *lake, *(x for n, p in out.items() for x in (f"--{n}", p))])
        assert spark.read.parquet(out["trades"]).count() == 4
    finally:
        for name in (db, f"{db}_reports"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_every_job_takes_its_time_as_an_argument():
    args = parser().parse_args(["report", "--as-of", "2024-01-15 12:00:00", "--symbol", "X"])
    assert args.as_of == "2024-01-15 12:00:00"
