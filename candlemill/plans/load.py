"""The daily jobs: lake to warehouse, warehouse to reports.

Every job covers all symbols at once, takes its time as an argument, and can be
run again for the same day without changing the result.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..operators import clean, derive, filters, incremental, keys
from ..schemas import PRICE
from ..session import pin
from ..sources import lake, warehouse
from . import books, reports
from .land import land_tickers, land_to_lake, landing_report, trade_watermarks  # noqa: F401  jobs are found here


def load_warehouse(
    spark: SparkSession,
    lake_root: str,
    day: date,
    database: str = warehouse.WAREHOUSE_DATABASE,
) -> None:
    """Load one lake day into all warehouse tables: one write per table."""
    load_symbols(spark, lake_root, day, database)
    load_trades(spark, lake_root, day, database)
    load_klines(spark, lake_root, day, database)
    load_ticker(spark, lake_root, day, database)


def load_symbols(spark: SparkSession, lake_root: str, day: date, database: str) -> None:
    """Symbol dictionary, metadata and the nine filter tables of new loads."""
    load = books.begin(spark, database, "symbol_infor", day)
    stored = spark.table(f"`{database}`.symbol_infor").where(F.col("load_date") == F.lit(day))
    dim = spark.table(f"`{database}`.symbol_dim")
    raw = lake.read_lake_day(spark, lake_root, "SymbolInfor", day)
    observed, seen = books.observed(raw, clean.PRECISION_TYPES, ["symbol"], "symbol_infor")
    loads = clean.clean_symbols(observed)
    load.note_rejects(seen.get)
    new = incremental.new_rows(loads, stored, ["symbol", "load_date", "load_hash"])
    versioned = pin(keys.assign_versions(new, load.latest_ids("filterstype_id")))

    warehouse.append(keys.extend_symbol_dim(versioned, dim), database, "symbol_dim")
    load_filters(spark, loads, versioned, day, database, load.follows_end)
    # Last, because its rows mark the load as done.
    warehouse.append(versioned.drop("filters"), database, "symbol_infor")
    load.note_ids(versioned, "filterstype_id")
    load.end()


def load_filters(
    spark: SparkSession, loads: DataFrame, versioned: DataFrame, day: date, database: str, follows_end: bool = False
) -> None:
    """The filters of new versions: nine writes into the partition of their day.

    What a run that broke off has already put there is not put there again;
    ``follows_end`` says that the metadata load before did not break off.
    Values that don't fit are counted over all loads of the day.
    """
    load = books.begin(spark, database, "filters", day)
    counts = [c.alias(name) for name, c in filters.filter_rejects().items()]
    lacking = F.count_if(F.col("filterType").isNull()).alias("no key")
    every = filters.explode_filters(loads.withColumn("filterstype_id", F.lit(0)))
    load.note_rejects(every.agg(F.count("*").alias("n_rows"), lacking, *counts).first().asDict())
    exploded = pin(filters.explode_filters(versioned))
    for name, detail in filters.filter_details(exploded).items() if not exploded.isEmpty() else ():
        table = f"`{database}`.`{name}`"
        if not (load.follows_end and follows_end):
            there = spark.table(table).where(F.col("load_date") == F.lit(day)).select(*filters.PARENT_KEYS).distinct()
            detail = detail.join(there, list(filters.PARENT_KEYS), "left_anti")
        rows = warehouse.laid_out(detail.withColumn("load_date", F.lit(day)), name)
        warehouse.insert_partition(rows, table, {"load_date": str(day)})
    load.end()


def load_trades(spark: SparkSession, lake_root: str, day: date, database: str) -> None:
    """New trades; before them the days they may be of, after them the ids that are there now."""
    load = books.begin(spark, database, "trades", day)
    stored = spark.table(f"`{database}`.trades")
    raw = lake.read_lake_day(spark, lake_root, "Trades", day)
    observed, seen = books.observed(raw, clean.TRADE_TYPES, ["id", "time", "symbol"], "trades")
    batch = pin(clean.clean_trades(observed))
    days = pin(batch.select("trade_date").distinct().dropna())
    warehouse.note(days.withColumn("load_no", F.lit(load.number).cast("long")), database, "trade_journal")
    warehouse.append(incremental.new_trades(batch, stored, days), database, "trades")
    load.note_rejects(seen.get)
    ranges = pin(incremental.id_ranges(batch.dropna(subset=["trade_date"])).withColumn("load_date", F.lit(day)))
    warehouse.overwrite_partitions(ranges, f"`{database}`.trade_id_ranges")
    mark = keys.latest_ids(ranges, "last_id", "trade_id").withColumn("load_date", F.lit(day))
    warehouse.overwrite_partitions(mark, f"`{database}`.trade_watermarks")
    load.end()


def load_klines(spark: SparkSession, lake_root: str, day: date, database: str) -> None:
    """New candles, and fuller ones in the place of those stored while their minute was open."""
    raw = clean.name_kline_fields(lake.read_lake_day(spark, lake_root, "Klines", day))
    observed, seen = books.observed(raw, clean.KLINE_TYPES, ["open_ms", "symbol"], "klines")
    batch = pin(clean.clean_klines(observed))
    store_klines(spark, batch, seen, day, database)


def store_klines(spark: SparkSession, batch: DataFrame, seen: Observation | None, day: date, database: str) -> None:
    """A written batch of candles into the stored ones."""
    load = books.begin(spark, database, "klines", day)
    stored = spark.table(f"`{database}`.klines")
    if seen is not None:
        load.note_rejects(seen.get)
    changed = pin(incremental.changed_klines(batch.withColumn("open_date", F.to_date("opentime")), stored))
    new = changed.where("kline_id is null").drop("kline_id")
    numbered = pin(keys.sequential_ids(new, ["symbol"], ["opentime"], "kline_id", load.latest_ids("kline_id")))
    same = stored.join(changed.select("open_date").distinct(), "open_date", "left_semi").join(
        changed.select("symbol", "open_date", "opentime"), ["symbol", "open_date", "opentime"], "left_anti"
    )
    # Written first, because a table can't be read while its partitions are replaced.
    days = pin(
        changed.where("kline_id is not null").unionByName(numbered).unionByName(same.select(changed.columns))
    )
    warehouse.overwrite_partitions(warehouse.laid_out(days, "klines"), f"`{database}`.klines")
    load.note_ids(numbered, "kline_id")
    load.end()


def load_ticker(spark: SparkSession, lake_root: str, day: date, database: str) -> None:
    raw = lake.read_lake_day(spark, lake_root, "Ticker_24h", day)
    observed, seen = books.observed(raw, clean.TICKER_TYPES, ["closeTime", "symbol"], "ticker_24h")
    batch = pin(clean.clean_ticker(observed))
    store_ticker(spark, batch, seen, day, database)


def store_ticker(spark: SparkSession, batch: DataFrame, seen: Observation | None, day: date, database: str) -> None:
    """A written batch of statistics behind the stored ones; only days that the batch has are read."""
    load = books.begin(spark, database, "ticker_24h", day)
    if seen is not None:
        load.note_rejects(seen.get)
    stored = spark.table(f"`{database}`.ticker_24h")
    batch = batch.withColumn("close_date", F.to_date("closeTime"))
    new = incremental.new_rows(batch, stored, ["symbol", "close_date", "closeTime"], "close_date")
    latest = load.latest_ids("ticker_id")
    numbered = pin(keys.sequential_ids(new, ["symbol"], ["closeTime"], "ticker_id", latest))
    warehouse.append(numbered, database, "ticker_24h")
    load.note_ids(numbered, "ticker_id")
    load.end()


def derive_market(spark: SparkSession, as_of: datetime, database: str = warehouse.WAREHOUSE_DATABASE) -> None:
    """Candles and 24-hour statistics from stored trades up to ``as_of``, into their tables.

    Candles are made of the days that loads touched since they were last made,
    and of the two days up to ``as_of``, whose last minute may have been open. The
    statistics read two days of trades; the price before them comes from the
    candles. Order-book prices don't follow from trades and are NULL.
    """
    day = as_of.date()
    start, _ = times.report_bounds(as_of)
    trades = spark.table(f"`{database}`.trades").where(
        (F.col("trade_date") <= F.lit(day)) & (F.col("trade_time") <= times.utc_literal(as_of))
    )
    journal = spark.table(f"`{database}`.trade_journal").where(F.col("trade_date") <= F.lit(day))
    known = spark.table(f"`{database}`.derived_days").groupBy("trade_date").agg(F.max("load_no").alias("known"))
    touched = pin(
        journal.groupBy("trade_date").agg(F.max("load_no").alias("load_no")).join(known, "trade_date", "left")
        .where(F.col("known").isNull() | (F.col("known") < F.col("load_no")) | (F.col("trade_date") >= F.lit(start.date())))
    )
    # One narrow row per calendar day, so the scan is pruned to these days.
    of_days = trades.join(F.broadcast(touched.select("trade_date")), "trade_date", "left_semi")
    store_klines(spark, pin(derive.klines_from_trades(of_days)), None, day, database)
    # The last day isn't over yet.
    done = touched.where(F.col("trade_date") < F.lit(day)).select("trade_date", "load_no")
    warehouse.note(done, database, "derived_days")

    window = trades.where(F.col("trade_date") >= F.lit(start.date()))
    previous = derive.last_prices_before(window, spark.table(f"`{database}`.klines"), start)
    stats = derive.ticker_from_trades(window, as_of, previous)
    renamed = stats.withColumnsRenamed({"firstId": "firstTradeId", "lastId": "lastTradeId"})
    none = F.lit(None).cast(PRICE)
    store_ticker(spark, pin(renamed.withColumns({"bidPrice": none, "askPrice": none})), None, day, database)


def refresh_ledger(spark: SparkSession, as_of: datetime, database: str, report_database: str) -> DataFrame:
    """Count anew the days up to ``as_of`` that loads touched since they were counted; returns the ledger.

    A warehouse without a journal has all its days counted.
    """
    target = f"`{report_database}`."
    trades = spark.table(f"`{database}`.trades").where(F.col("trade_date") <= F.lit(as_of.date()))
    journal = spark.table(f"`{database}`.trade_journal")
    known = spark.table(f"{target}daily_ledger_loads").select(F.col("day").alias("trade_date"), F.col("load_no").alias("known"))
    if not journal.isEmpty():
        touched = journal.where(F.col("trade_date") <= F.lit(as_of.date())).groupBy("trade_date").agg(F.max("load_no").alias("load_no"))
        days = pin(touched.join(known, "trade_date", "left").where("known is null or known < load_no").drop("known"))
        # One narrow row per calendar day, so the scan is pruned to these days.
        trades = trades.join(F.broadcast(days.select("trade_date")), "trade_date", "left_semi")
    counted = pin(reports.daily_ledger(trades))
    warehouse.overwrite_partitions(counted.select("NumberOfTrades", "day"), f"{target}daily_trade_ledger")
    if not journal.isEmpty():
        warehouse.overwrite_partitions(days.select("load_no", F.col("trade_date").alias("day")), f"{target}daily_ledger_loads")
    return spark.table(f"{target}daily_trade_ledger")


def refresh_reports(
    spark: SparkSession,
    as_of: datetime,
    symbol: str,
    database: str = warehouse.WAREHOUSE_DATABASE,
    report_database: str = warehouse.REPORT_DATABASE,
) -> None:
    """Replace the four report tables for the day up to ``as_of``."""
    warehouse.create_reports(spark, report_database)
    trades = spark.table(f"`{database}`.trades")
    # A day more at both ends, whatever the zone of ``as_of``; the report cuts exactly.
    klines = spark.table(f"`{database}`.klines").where(
        F.col("open_date").between(
            F.lit(as_of.date() - timedelta(days=2)), F.lit(as_of.date() + timedelta(days=1))
        )
    )
    target = f"`{report_database}`."

    counts = reports.daily_trade_counts(trades, as_of)
    warehouse.full_refresh(counts, f"{target}number_of_trades_symbols")

    ledger = refresh_ledger(spark, as_of, database, report_database)
    total = reports.total_trades(ledger, trades, as_of)
    warehouse.full_refresh(total, f"{target}total_trades")

    quoted = symbol.replace("`", "``")
    warehouse.full_refresh(
        reports.symbol_trades(trades, symbol, as_of), f"{target}`{quoted}_trades`"
    )
    warehouse.full_refresh(
        reports.symbol_klines(klines, symbol, as_of), f"{target}`{quoted}_klines`"
    )


def run_day(
    spark: SparkSession,
    lake_root: str,
    as_of: datetime,
    symbol: str,
    database: str = warehouse.WAREHOUSE_DATABASE,
    report_database: str = warehouse.REPORT_DATABASE,
) -> None:
    """The whole daily run after ingestion."""
    warehouse.create_warehouse(spark, database)
    load_warehouse(spark, lake_root, as_of.date(), database)
    refresh_reports(spark, as_of, symbol, database, report_database)
