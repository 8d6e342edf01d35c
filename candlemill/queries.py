"""Every operator as a named query over the given tables.

Results use plain types, so that another engine can be compared with them:
decimals as doubles, times without zone, dates as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import times
from .functions.values import count_rejects
from .operators import clean, derive, filters, incremental, keys
from .plans import land, load, reports
from .schemas import FILTER_TYPES, PRICE
from .session import folder_exists, folder_names, scratch_path, use_utc
from .sources import lake, landing, tables, warehouse
from .sources.tables import AS_OF
from .streaming import trades as stream

DAY = AS_OF.date()
SYMBOL = "click"
MIDNIGHT = datetime(2024, 1, 15)
FIRST_DAY_END = datetime(2024, 1, 1, 23, 59, 59)
ORDERS_AS_OF = datetime(1998, 6, 15, 12)

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        return value.alias(field.name)

    return df.select(*(column(f) for f in df.schema))


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(use_utc(spark), sf_dir))

    _queries[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_queries)


# -- lake ---------------------------------------------------------------------

_lakes: dict[tuple[str, str], str] = {}


def _lake_root(spark: SparkSession, sf_dir: str) -> str:
    """The trades as a lake, written once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes or not folder_exists(spark, _lakes[key]):
        root = scratch_path(spark, "lake")
        day = F.to_date(F.timestamp_millis("time"))
        lake.write_lake(tables.raw_trades(spark, sf_dir), root, "Trades", day)
        _lakes[key] = root
    return _lakes[key]


@query
def lake_daily_slice(spark, sf):
    rows = lake.read_lake_day(spark, _lake_root(spark, sf), "Trades", DAY, SYMBOL)
    return rows.drop("isBestMatch")


@query
def lake_empty_slice(spark, sf):
    rows = lake.read_lake_day(spark, _lake_root(spark, sf), "Trades", date(2023, 12, 31), SYMBOL)
    return rows.select("symbol", "id", "time")


@query
def lake_row_counts(spark, sf):
    rows = lake.read_lake_day(spark, _lake_root(spark, sf), "Trades", DAY)
    return lake.row_counts(rows).withColumnRenamed("rows", "n_rows")


@query
def lake_round_trip(spark, sf):
    rows = lake.read_lake(spark, _lake_root(spark, sf), "Trades")
    return rows.groupBy(*lake.PARTITIONS).agg(
        F.count("*").alias("n_rows"), F.sum("id").alias("id_sum")
    )


# -- landed JSON --------------------------------------------------------------


@query
def raw_json_parse(spark, sf):
    raw = tables.raw_trades(spark, sf)
    text = raw.select("symbol", F.to_json(F.struct(*raw.drop("symbol").columns)).alias("text"))
    parsed = landing.parse_record(F.col("text"), "Trades")
    trades = text.select("symbol", parsed.alias("t")).select("symbol", "t.*")
    return clean.clean_trades(trades).drop("isBestMatch")


@query
def raw_json_klines(spark, sf):
    raw = tables.raw_klines(spark, sf)
    text = F.format_string(
        '[[%d,"%s","%s","%s","%s","%s",%d,"%s",%d,"%s","%s","%s"]]',
        *(f"_{i}" for i in range(1, 13)),
    )
    page = landing.parse_kline_page(F.col("text"))
    parsed = raw.select("symbol", text.alias("text")).select("symbol", F.explode(page).alias("k"))
    return clean.clean_klines(parsed.select("symbol", "k.*"))


@query
def raw_json_filters(spark, sf):
    part = tables.table(spark, sf, "part")
    text = F.format_string(
        '{"status":"TRADING","filters":[{"filterType":"ICEBERG_PARTS","limit":%d},'
        '{"filterType":"NOTIONAL","minNotional":"%s","applyMinToMarket":true}]}',
        F.col("p_size"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string"),
    )
    parsed = landing.parse_record(text, "SymbolInfor")
    entries = part.select(
        F.col("p_partkey").cast("string").alias("symbol"), F.explode(parsed["filters"]).alias("f")
    )
    return entries.select(
        "symbol",
        F.col("f")["filterType"].alias("filter_type"),
        F.coalesce(F.col("f")["limit"], F.col("f")["minNotional"]).alias("value_text"),
        F.col("f")["applyMinToMarket"].alias("flag_text"),
    )


@query
def decimal_rejects(spark, sf):
    raw = tables.raw_trades(spark, sf)
    large = F.col("price").cast("decimal(20,2)") * F.lit(100_000_000)
    rejects = count_rejects(
        raw.withColumn("price", large.cast("string")), {"price": PRICE, "qty": PRICE}, ["symbol"]
    )
    return rejects.withColumnRenamed("rows", "n_rows")


LANDED_DAY = date(2024, 1, 15)
PAGE = 20


def _land(spark: SparkSession, sf: str) -> str:
    """Trades landed as pages and single records, some of them broken; landed twice.

    Ids below 10,000 come in pages of which every seventh is cut off, the others
    one to a line: some are cut off, some have an id that is no number or none.
    """
    raw = tables.raw_trades(spark, sf)
    page = F.floor(F.col("id") / PAGE)
    fields = [F.col(c) for c in raw.drop("symbol").columns]
    # At most PAGE records of one symbol.
    pages = (
        raw.where(F.col("id") < 10_000).groupBy("symbol", page.alias("page"))
        .agg(F.to_json(F.collect_list(F.struct(*fields))).alias("value"))
        .select("symbol", F.when(F.col("page") % 7 == 3, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
    )
    text = F.to_json(F.struct(*fields))
    value = (
        F.when(F.col("id") % 97 == 0, F.expr("left(value, length(value) - 5)"))
        .when(F.col("id") % 89 == 0, F.regexp_replace("value", '"id":([0-9]+)', '"id":"x$1"'))
        .when(F.col("id") % 83 == 0, F.regexp_replace("value", '"id":[0-9]+,', ""))
        .otherwise(F.col("value"))
    )
    lines = raw.where(F.col("id") >= 10_000).withColumn("value", text).select("symbol", value.alias("value"))
    root, lake_root = scratch_path(spark, "landing"), scratch_path(spark, "landed-lake")
    pages.unionByName(lines).write.partitionBy("symbol").text(f"{root}/Trades/day={LANDED_DAY}")
    for _ in range(2):
        land.land_to_lake(spark, root, lake_root, LANDED_DAY)
    return lake_root


@query
def landing_rejects(spark, sf):
    """Kept and rejected records by symbol, and the lines they came in; a table without files has none."""
    lake_root = _land(spark, sf)
    kept = lake.read_lake_day(spark, lake_root, "Trades", LANDED_DAY).groupBy("symbol").agg(F.count("*").alias("n"))
    lost = land.read_rejects(spark, lake_root).groupBy("symbol", "reason").agg(F.count("*").alias("n"))
    lines = land.read_landed(spark, lake_root).groupBy("symbol").agg(F.sum("n_lines").alias("n"))
    report = land.landing_report(spark, lake_root, LANDED_DAY).where("status = 'empty'")
    return (
        kept.select("symbol", F.lit("kept").alias("kind"), "n")
        .unionByName(lost.select("symbol", F.col("reason").alias("kind"), "n"))
        .unionByName(lines.select("symbol", F.lit("lines").alias("kind"), "n"))
        .unionByName(report.select(F.col("table").alias("symbol"), "status", F.col("n_lines").alias("n")).toDF("symbol", "kind", "n"))
    )


# -- cleaning and scalar functions --------------------------------------------


@query
def trades_clean(spark, sf):
    return clean.clean_trades(tables.raw_trades(spark, sf))


@query
def klines_clean(spark, sf):
    return clean.clean_klines(tables.raw_klines(spark, sf))


@query
def ticker_clean(spark, sf):
    return clean.clean_ticker(tables.raw_tickers(spark, sf))


@query
def symbol_infor(spark, sf):
    return _versions(spark, sf).drop("filters", "load_hash")


@query
def epoch_ms_to_ts(spark, sf):
    ms = F.col("ms")
    events = tables.table(spark, sf, "events")
    return events.select("event_id", times.time_to_epoch_ms(F.col("ts")).alias("ms")).select(
        "event_id",
        "ms",
        times.epoch_ms_to_time(ms).alias("trade_time"),
        times.epoch_ms_to_text(ms).alias("trade_time_text"),
    )


@query
def date_parts(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return tables.table(spark, sf, "events").select(
        "event_id",
        *(c.alias(f"{n}_text") for n, c in times.lake_date_parts(F.col("ts")).items()),
        *(c.alias(f"{n}_split") for n, c in times.text_date_parts(text).items()),
        F.year("ts").alias("year_no"),
        F.month("ts").alias("month_no"),
        F.dayofmonth("ts").alias("day_no"),
    )


@query
def report_bounds(spark, sf):
    as_of = F.col("o_orderdate").cast("timestamp")
    return tables.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_trunc("second", as_of).alias("current_time"),
        times.previous_day(as_of).alias("previous_time"),
    )


# -- filters ------------------------------------------------------------------


def _loads(spark, sf):
    return clean.clean_symbols(tables.raw_symbols(spark, sf))


def _versions(spark, sf):
    return keys.assign_versions(_loads(spark, sf), None)


def _exploded(spark, sf):
    return filters.explode_filters(_versions(spark, sf))


@query
def filters_exploded(spark, sf):
    exploded = _exploded(spark, sf)
    return exploded.withColumn("n_keys", F.size("filter")).drop("filter")


def _register_filter(name: str, filter_type: str) -> None:
    def build(spark, sf):
        return filters.filter_detail(_exploded(spark, sf), filter_type)

    build.__name__ = name
    query(build)


FILTER_KEYS = {
    "filter_price": "PRICE_FILTER",
    "filter_lot_size": "LOT_SIZE",
    "filter_iceberg_parts": "ICEBERG_PARTS",
    "filter_market_lot_size": "MARKET_LOT_SIZE",
    "filter_trailing_delta": "TRAILING_DELTA",
    "filter_percent_price": "PERCENT_PRICE_BY_SIDE",
    "filter_notional": "NOTIONAL",
    "filter_max_orders": "MAX_NUM_ORDERS",
    "filter_max_algo_orders": "MAX_NUM_ALGO_ORDERS",
}
for _name, _type in FILTER_KEYS.items():
    _register_filter(_name, _type)
assert set(FILTER_KEYS.values()) == set(FILTER_TYPES)


@query
def filter_matrix(spark, sf):
    return filters.filter_matrix(_exploded(spark, sf))


@query
def filter_version(spark, sf):
    loads = _loads(spark, sf)
    first_day = F.col("load_date") == F.lit(date(2024, 1, 14))
    stored = loads.where(first_day).groupBy("symbol").agg(F.count("*").alias("latest_id"))
    later = keys.assign_versions(loads.where(~first_day), stored)
    return later.select("symbol", "load_date", "filterstype_id", "status")


@query
def current_symbols(spark, sf):
    current = filters.current_versions(_versions(spark, sf).drop("filters", "load_hash"))
    return current.select("symbol", "filterstype_id", "load_date", "status")


# -- keys ---------------------------------------------------------------------


def _users_until(spark, sf, until: datetime):
    trades = tables.trades(spark, sf, "user_id")
    return trades.where(F.col("trade_time") <= times.utc_literal(until)).select("symbol")


def _first_dim(spark, sf):
    empty = spark.createDataFrame([], "symbol_id bigint, symbol string")
    return keys.extend_symbol_dim(_users_until(spark, sf, FIRST_DAY_END), empty)


def _dim(spark, sf):
    first = _first_dim(spark, sf)
    return first.unionByName(keys.extend_symbol_dim(tables.trades(spark, sf, "user_id"), first))


@query
def symbol_dim(spark, sf):
    return _dim(spark, sf)


@query
def first_symbols(spark, sf):
    return keys.first_symbols(_dim(spark, sf))


@query
def distinct_symbols(spark, sf):
    return tables.trades(spark, sf, "user_id").select("symbol").distinct()


@query
def symbol_id_lookup(spark, sf):
    trades = tables.trades(spark, sf, "user_id").select("trade_id", "symbol")
    return keys.with_symbol_id(trades, _first_dim(spark, sf), spread_by="trade_id")


@query
def latest_trade_id(spark, sf):
    return keys.latest_ids(tables.trades(spark, sf, "user_id"), "trade_id")


@query
def latest_order_id(spark, sf):
    return keys.latest_ids(tables.order_trades(spark, sf, "o_custkey"), "trade_id")


@query
def top_trade(spark, sf):
    top = keys.top_by(tables.trades(spark, sf), "trade_id")
    return top.select("trade_id", "symbol", "price", "trade_time")


@query
def kline_ids(spark, sf):
    klines = derive.klines_from_trades(tables.trades(spark, sf))
    old = F.col("opentime") < times.utc_literal(MIDNIGHT)
    latest = klines.where(old).groupBy("symbol").agg(F.count("*").alias("latest_id"))
    new = klines.where(~old).select("symbol", "opentime", "closePrice")
    return keys.sequential_ids(new, ["symbol"], ["opentime"], "kline_id", latest)


# -- incremental --------------------------------------------------------------


def _stored(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("trade_time") < times.utc_literal(MIDNIGHT))


@query
def incremental_trades(spark, sf):
    trades = tables.trades(spark, sf, "user_id")
    latest = keys.latest_ids(_stored(trades), "trade_id")
    return incremental.after_watermark(trades.select("symbol", "trade_id"), latest)


@query
def append_new_trades(spark, sf):
    trades = tables.trades(spark, sf)
    batch = incremental.concat_pages([trades, trades])
    new = incremental.new_trades(batch, _stored(trades))
    return new.select("symbol", "trade_id", "price", "trade_date")


@query
def append_new_klines(spark, sf):
    klines = derive.klines_from_trades(tables.trades(spark, sf))
    partial = klines.withColumn("numberoftrades", F.col("numberoftrades") - 1)
    old = F.col("opentime") < times.utc_literal(MIDNIGHT)
    pages = incremental.concat_pages([partial, klines])
    new = incremental.new_klines(pages, klines.where(old))
    return new.select("symbol", "opentime", "numberoftrades")


@query
def replace_partial_klines(spark, sf):
    """Of the stored candles, those of even minutes lack a trade that the batch has."""
    klines = derive.klines_from_trades(tables.trades(spark, sf)).withColumn("open_date", F.to_date("opentime"))
    lacking = 1 - F.minute("opentime") % 2
    stored = klines.where(F.col("opentime") < times.utc_literal(MIDNIGHT)).select(
        "symbol", "opentime", "open_date", (F.col("numberoftrades") - lacking).alias("numberoftrades"),
        F.lit(7).cast("bigint").alias("kline_id"),
    )
    changed = incremental.changed_klines(klines, stored)
    kept = F.coalesce("kline_id", F.lit(0).cast("bigint")).alias("kline_id")
    return changed.select("symbol", "opentime", "numberoftrades", kept)


@query
def page_concat(spark, sf):
    trades = tables.trades(spark, sf)
    noon = times.utc_literal(AS_OF)
    pages = [
        trades.where(F.col("trade_time") <= noon),
        trades.where(F.col("trade_time") >= times.utc_literal(MIDNIGHT)),
    ]
    whole = incremental.concat_pages(pages)
    return whole.groupBy("symbol").agg(
        F.count("*").alias("n_rows"), F.sum("trade_id").alias("id_sum")
    )


@query
def ticker_increment(spark, sf):
    latest = keys.latest_ids(_stored(tables.trades(spark, sf, "user_id")), "trade_id")
    resumed = incremental.resume_tickers(tables.raw_tickers(spark, sf), latest)
    return resumed.select("symbol", "firstId", "lastId", "count", "count_inclusive")


@query
def valid_tickers(spark, sf):
    tickers = tables.raw_tickers(spark, sf, FIRST_DAY_END)
    return incremental.valid_tickers(tickers).select("symbol", "firstId", "lastId")


@query
def trade_fetch_plan(spark, sf):
    tickers = tables.raw_tickers(spark, sf, symbol="event_type")
    return incremental.trade_fetch_plan(tickers, step=50)


GAP_SYMBOL_IDS = 4096


def _gap_trades(spark, sf):
    """Trades whose symbol is a run of ids, so that only lost pages leave holes."""
    raw = tables.raw_trades(spark, sf)
    return raw.withColumn("symbol", F.floor(F.col("id") / GAP_SYMBOL_IDS).cast("string"))


@query
def trade_gap_plan(spark, sf):
    """What to fetch after two days that each lost pages: exactly the missing ids."""
    raw = _gap_trades(spark, sf)
    block = F.floor(F.col("id") / 64)
    arrivals = (raw.where((block % 2 == 0) & (block % 7 != 3)), raw.where((block % 2 == 1) & (block % 5 != 1)))
    database = _load_job(spark, "Trades", arrivals, load.load_trades)
    tickers = raw.groupBy("symbol").agg(F.min("id").alias("firstId"), F.max("id").alias("lastId"))
    # The ticker of a day doesn't go back to the first ids; what is stored does.
    tickers = tickers.withColumn("firstId", F.col("firstId") + 1000)
    return incremental.missing_trade_pages(tickers, spark.table(f"{database}.trade_id_ranges"), step=50)


@query
def kline_fetch_plan(spark, sf):
    return incremental.kline_fetch_plan(tables.raw_tickers(spark, sf))


# -- derived tables -----------------------------------------------------------


@query
def klines_from_trades(spark, sf):
    return derive.klines_from_trades(tables.trades(spark, sf))


@query
def klines_from_orders(spark, sf):
    return derive.klines_from_trades(tables.order_trades(spark, sf))


@query
def ticker_from_trades(spark, sf):
    return derive.ticker_from_trades(tables.trades(spark, sf, "user_id"), AS_OF)


@query
def ticker_from_klines(spark, sf):
    start, _ = times.report_bounds(AS_OF)
    klines = derive.klines_from_trades(tables.trades(spark, sf))
    day = tables.trades(spark, sf, day_up_to=AS_OF)
    return derive.ticker_from_trades(day, AS_OF, derive.last_closes(klines, start))


@query
def ticker_from_orders(spark, sf):
    return derive.ticker_from_trades(tables.order_trades(spark, sf), ORDERS_AS_OF)


# -- reports ------------------------------------------------------------------


@query
def daily_trade_counts(spark, sf):
    return reports.daily_trade_counts(tables.trades(spark, sf, day_up_to=AS_OF), AS_OF)


@query
def lineitem_trade_counts(spark, sf):
    trades = tables.line_trades(spark, sf)
    return trades.groupBy("symbol").agg(
        F.count("*").alias("NumberOfTrades"),
        F.sum("qty").alias("volume"),
        F.min("price").alias("lowPrice"),
        F.max("price").alias("highPrice"),
    )


@query
def total_trades(spark, sf):
    trades = tables.trades(spark, sf)
    return reports.total_trades(reports.daily_ledger(trades), trades, AS_OF)


@query
def running_total_trades(spark, sf):
    return reports.running_totals(reports.daily_ledger(tables.trades(spark, sf)))


@query
def lineitem_running_totals(spark, sf):
    return reports.running_totals(reports.daily_ledger(tables.line_trades(spark, sf)))


@query
def symbol_trades_series(spark, sf):
    day = tables.trades(spark, sf, day_up_to=AS_OF)
    return reports.symbol_trades(day, SYMBOL, AS_OF)


@query
def symbol_klines_series(spark, sf):
    klines = derive.klines_from_trades(tables.trades(spark, sf))
    return reports.symbol_klines(klines, SYMBOL, AS_OF)


# -- streams ------------------------------------------------------------------


def _stream_trades(spark, sf):
    path = scratch_path(spark, "stream-trades")
    root = _lake_root(spark, sf)
    stream.load_new_trades(spark, root, path, scratch_path(spark, "state")).awaitTermination()
    return path


@query
def stream_trades(spark, sf):
    stored = stream.stored_trades(spark, _stream_trades(spark, sf))
    return stored.select("symbol", "trade_id", "price", "trade_time")


@query
def stream_distinct_trades(spark, sf):
    """The same load in small batches, and once more without its checkpoint."""
    path = scratch_path(spark, "stream-distinct")
    root = _lake_root(spark, sf)
    for _ in range(2):
        state = scratch_path(spark, "state")
        stream.load_new_trades(spark, root, path, state, files_per_batch=40).awaitTermination()
    stored = stream.stored_trades(spark, path)
    return stored.select("symbol", "trade_id", "price", "trade_time")


@query
def stream_klines(spark, sf):
    trades = _stream_trades(spark, sf)
    path = scratch_path(spark, "stream-klines")
    state = scratch_path(spark, "state")
    stream.load_new_klines(spark, trades, path, state, files_per_batch=40).awaitTermination()
    return stream.stored_klines(spark, path)


@query
def stream_klines_compacted(spark, sf):
    """The same with late and shuffled files one by one, and parts that are written together."""
    root, trades = scratch_path(spark, "late-lake"), scratch_path(spark, "late-trades")
    path, states = scratch_path(spark, "late-klines"), [scratch_path(spark, "state") for _ in range(2)]
    raw = tables.raw_trades(spark, sf)
    arrival = F.pmod(F.xxhash64("id"), F.lit(3))
    for k in range(3):
        lake.write_lake(raw.where(arrival <= k), root, "Trades", LANDED_DAY)
        stream.load_new_trades(spark, root, trades, states[0]).awaitTermination()
        stream.load_new_klines(spark, trades, path, states[1], files_per_batch=60).awaitTermination()
        if k == 1:
            stream.compact_klines(spark, path, max(int(n.split("=")[1]) for n in folder_names(spark, path)))
    return stream.stored_klines(spark, path)


# -- jobs ---------------------------------------------------------------------

# What arrives on the second day overlaps the first; the first is loaded once more at the end.
ARRIVALS = (date(2024, 1, 14), date(2024, 1, 15))
LOADS = (*ARRIVALS, ARRIVALS[0])


def _job_database(spark: SparkSession) -> str:
    """A fresh database below the scratch folder."""
    name = f"jobs_{uuid.uuid4().hex}"
    warehouse.create_database(spark, name, scratch_path(spark, "jobs"))
    return name


def _load_job(spark, name: str, arrivals, job, database: str | None = None) -> str:
    """Arrivals of two days in the lake, loaded into a database by a daily job."""
    if database is None:
        database = _job_database(spark)
        warehouse.create_warehouse(spark, database)
    root = scratch_path(spark, "job-lake")
    for rows, day in zip(arrivals, ARRIVALS, strict=True):
        lake.write_lake(rows, root, name, day)
    for day in LOADS:
        job(spark, root, day, database)
    return database


def _job_trades(spark, sf, database=None) -> str:
    raw = tables.raw_trades(spark, sf)
    before = F.col("time") < times.time_to_epoch_ms(times.utc_literal(MIDNIGHT))
    since = F.col("time") >= times.time_to_epoch_ms(times.utc_literal(MIDNIGHT - timedelta(days=5)))
    return _load_job(spark, "Trades", (raw.where(before), raw.where(since)), load.load_trades, database)


def _job_klines(spark, sf, database=None) -> str:
    """On the first day, candles of even minutes lack a trade."""
    raw = tables.raw_klines(spark, sf)
    lacking = 1 - F.minute(F.timestamp_millis("_1")) % 2
    before = F.col("_1") < times.time_to_epoch_ms(times.utc_literal(MIDNIGHT))
    first = raw.where(before).withColumn("_9", F.col("_9") - lacking)
    return _load_job(spark, "Klines", (first, raw), load.load_klines, database)


@query
def job_trades(spark, sf):
    stored = spark.table(f"{_job_trades(spark, sf)}.trades")
    return stored.select("symbol", "trade_id", "price", "qty", "trade_time", "trade_date")


@query
def job_klines(spark, sf):
    stored = spark.table(f"{_job_klines(spark, sf)}.klines")
    return stored.select("symbol", "opentime", "closePrice", "numberoftrades", "kline_id")


@query
def job_ticker(spark, sf):
    arrivals = [
        tables.raw_tickers(spark, sf, as_of, "event_type") for as_of in (AS_OF - timedelta(days=1), AS_OF)
    ]
    stored = spark.table(f"{_load_job(spark, 'Ticker_24h', arrivals, load.load_ticker)}.ticker_24h")
    return stored.select("symbol", "closeTime", "lastPrice", "firstTradeId", "lastTradeId", "count", "ticker_id")


DERIVED_AT = AS_OF + timedelta(seconds=30)


def _derived(spark, sf) -> str:
    """Stored trades, and candles and statistics made of them at two times within a minute."""
    database = _job_trades(spark, sf)
    for as_of in (DERIVED_AT - timedelta(days=1), DERIVED_AT):
        load.derive_market(spark, as_of, database)
    return database


@query
def job_derived_klines(spark, sf):
    stored = spark.table(f"{_derived(spark, sf)}.klines")
    return stored.select("symbol", "opentime", "openPrice", "closePrice", "volume", "numberoftrades", "kline_id")


@query
def job_derived_ticker(spark, sf):
    stored = spark.table(f"{_derived(spark, sf)}.ticker_24h")
    return stored.select(
        "symbol", "closeTime", "prevClosePrice", "lastPrice", "weightedAvgPrice", "firstTradeId", "lastTradeId", "count", "ticker_id"
    )


@query
def job_rejects(spark, sf):
    """What didn't fit in two loads of the trades, the second of each day in the place of the first."""
    raw = tables.raw_trades(spark, sf)
    large = (F.col("price").cast("decimal(20,2)") * F.lit(100_000_000)).cast("string")
    unfit = raw.withColumn("price", large).withColumn("qty", F.when(F.col("id") % 5 == 0, "n/a").otherwise(F.col("qty")))
    unfit = unfit.withColumn("id", F.when(F.col("id") % 11 > 0, F.col("id")))
    before = F.col("time") < times.time_to_epoch_ms(times.utc_literal(MIDNIGHT))
    database = _load_job(spark, "Trades", (raw.where(before), unfit.where(~before)), load.load_trades)
    rejects = spark.table(f"{database}.load_rejects")
    return rejects.select("load_date", F.coalesce("column_name", F.lit("")).alias("column_name"), "n_rows", "n_rejects")


_symbol_jobs: dict[tuple[str, str], str] = {}


def _job_symbols(spark, sf) -> str:
    """The database of ``_load_symbol_job``, made once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _symbol_jobs or not spark.catalog.databaseExists(_symbol_jobs[key]):
        _symbol_jobs[key] = _load_symbol_job(spark, sf)
    return _symbol_jobs[key]


def _load_symbol_job(spark, sf) -> str:
    """Metadata of two days, the first of them loaded again and then changed and loaded once more."""
    raw = tables.raw_symbols(spark, sf)
    rows = raw.drop("year", "month", "day")
    days = [rows.where(raw["day"] == day.day) for day in ARRIVALS]
    database = _load_job(spark, "SymbolInfor", days, load.load_symbols)
    root = scratch_path(spark, "job-lake")
    changed = days[0].where("baseAssetPrecision % 2 = 0").withColumn("status", F.lit("HALT"))
    lake.write_lake(changed.unionByName(changed), root, "SymbolInfor", ARRIVALS[0])
    load.load_symbols(spark, root, ARRIVALS[0], database)
    return database


@query
def job_symbols(spark, sf):
    stored = spark.table(f"{_job_symbols(spark, sf)}.symbol_infor")
    return stored.select("symbol", "load_date", "filterstype_id", "status", "baseAsset", "baseAssetPrecision", "icebergAllowed")


@query
def job_filters(spark, sf):
    """All nine filter tables of all versions, one row per value."""
    database = _job_symbols(spark, sf)
    out = None
    for kind in FILTER_TYPES.values():
        values = F.explode(F.array(*(
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in kind.columns
        )))
        rows = spark.table(f"{database}.{kind.table}").select(
            F.lit(kind.table.removesuffix("_detail")).alias("kind"), "symbol", "filter_type_id", "load_date", values.alias("v")
        ).select("kind", "symbol", "filter_type_id", "load_date", "v.*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def filter_join(spark, sf):
    """Prices and lots of each version side by side; the tables are bucketed alike, so nothing is shuffled."""
    database = _job_symbols(spark, sf)
    keys_of = ["symbol", "filter_type_id"]
    price = spark.table(f"{database}.price_filter_detail").select(*keys_of, "minPrice", "tickSize")
    lot = spark.table(f"{database}.lot_size_filter_detail").select(*keys_of, "minQty", "stepSize")
    return price.join(lot.hint("merge"), keys_of)


@query
def job_reports(spark, sf):
    """All report tables after two runs of one day at different hours."""
    database = _job_klines(spark, sf, _job_trades(spark, sf))
    made = _job_database(spark)
    for as_of in (AS_OF - timedelta(hours=2), AS_OF):
        load.refresh_reports(spark, as_of, SYMBOL, database, made)

    def part(kind: str, table: str, key, n):
        return spark.table(f"{made}.{table}").select(F.lit(kind).alias("kind"), key.alias("key"), n.alias("n"))

    def rows_of(table: str):
        rows = spark.table(f"{made}.`{SYMBOL}_{table}`").agg(F.count("*").alias("n"))
        return rows.select(F.lit(table).alias("kind"), F.lit(SYMBOL).alias("key"), "n")

    return (
        part("symbol", "number_of_trades_symbols", F.col("symbol"), F.col("NumberOfTrades"))
        .unionByName(part("day", "daily_trade_ledger", F.col("day").cast("string"), F.col("NumberOfTrades")))
        .unionByName(part("total", "total_trades", F.lit("all"), F.col("TotalTrades")))
        .unionByName(rows_of("trades"))
        .unionByName(rows_of("klines"))
    )
