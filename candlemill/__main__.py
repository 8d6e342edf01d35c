"""Jobs for ``spark-submit``: land, load, report, stream.

    python -m candlemill report --as-of "2024-01-15 12:00:00" --symbol BTCUSDT
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from .plans import load
from .session import build_session, drop_scratch
from .sources import warehouse
from .streaming import trades as stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="candlemill")
    top.add_argument("--hive", action="store_true", help="use the Hive metastore of the cluster")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> None:
        sub = jobs.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        sub.add_argument("--database", default=warehouse.WAREHOUSE_DATABASE)
        sub.add_argument("--reports", default=warehouse.REPORT_DATABASE)

    job("land", "landing", "lake", "as-of")
    job("plan-fetch", "landing", "lake", "as-of", "out")
    job("load", "lake", "as-of")
    job("derive", "as-of")
    job("report", "as-of", "symbol")
    job("run-day", "lake", "as-of", "symbol")
    job("stream", "lake", "trades", "klines", "state")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"candlemill-{args.job}", hive=args.hive)
    try:
        run(spark, args)
    finally:
        drop_scratch(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    as_of = datetime.fromisoformat(args.as_of) if hasattr(args, "as_of") else None
    if args.job == "land":
        load.land_to_lake(spark, args.landing, args.lake, as_of.date())
    elif args.job == "plan-fetch":
        warehouse.create_warehouse(spark, args.database)
        trades, klines = load.land_tickers(
            spark, args.landing, args.lake, as_of.date(), args.database
        )
        trades.write.mode("overwrite").parquet(f"{args.out}/trades")
        klines.write.mode("overwrite").parquet(f"{args.out}/klines")
    elif args.job == "load":
        warehouse.create_warehouse(spark, args.database)
        load.load_warehouse(spark, args.lake, as_of.date(), args.database)
    elif args.job == "derive":
        warehouse.create_warehouse(spark, args.database)
        load.derive_market(spark, as_of, args.database)
    elif args.job == "report":
        load.refresh_reports(spark, as_of, args.symbol, args.database, args.reports)
    elif args.job == "run-day":
        load.run_day(spark, args.lake, as_of, args.symbol, args.database, args.reports)
    elif args.job == "stream":
        stream.load_new_trades(
            spark, args.lake, args.trades, f"{args.state}/trades"
        ).awaitTermination()
        stream.load_new_klines(
            spark, args.trades, args.klines, f"{args.state}/klines"
        ).awaitTermination()


if __name__ == "__main__":
    main()
