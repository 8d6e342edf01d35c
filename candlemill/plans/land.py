"""Landing to lake: good records into the lake, the others and a list of files beside them.

``{lake}/Rejects/table=T/day=D`` keeps what was no record, ``{lake}/Landed/table=T/day=D``
one row per landed file. Both are replaced when a day lands again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import zero_if_missing
from ..operators import incremental, keys
from ..schemas import LAKE
from ..session import pin
from ..sources import lake, landing, warehouse

REJECTS, LANDED = "Rejects", "Landed"
#: One row per landed file.
FILE = "symbol string, file string, bytes bigint, n_lines bigint, n_rejects bigint"


def _side_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    schema = f"{schema}, table string, day date"
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_rejects(spark: SparkSession, lake_root: str) -> DataFrame:
    """What was landed and is no record, by table and day."""
    return _side_table(spark, lake_root, REJECTS, landing.REJECT)


def read_landed(spark: SparkSession, lake_root: str) -> DataFrame:
    """The landed files by table and day."""
    return _side_table(spark, lake_root, LANDED, FILE)


def trade_watermarks(spark: SparkSession, database: str) -> DataFrame:
    """Last stored trade id per symbol, from the small table each load adds to."""
    return keys.latest_ids(spark.table(f"`{database}`.trade_watermarks"), "trade_id")


def land_table(
    spark: SparkSession,
    landing_root: str,
    lake_root: str,
    table: str,
    day: date,
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One table's records of a day, in the place of what the lake has for the same symbols and day.

    Returns the rows written. Records are parsed once; only if there are rejects they are parsed again for
    the lines they stand in. ``change`` is applied to the good records.
    """
    lines = landing.landed_lines(spark, landing_root, table, day)
    found = landing.records(lines, table)
    seen = Observation(f"landing of {table}")
    # Written before anything is shuffled, where the count can't get lost with an empty shuffle.
    rows = pin(landing.good_records(found.observe(seen, F.count_if(F.col("reason").isNotNull()).alias("n_rejects"))))
    if change:
        rows = change(rows)
    lake.write_lake(rows, lake_root, table, day, replace=True)

    place = f"table={table}/day={day}"
    rejects = landing.rejected(found, lines) if seen.get["n_rejects"] else spark.createDataFrame([], landing.REJECT)
    rejects.write.mode("overwrite").parquet(f"{lake_root}/{REJECTS}/{place}")
    of_file = spark.read.schema(landing.REJECT).parquet(f"{lake_root}/{REJECTS}/{place}")
    files = (
        lines.groupBy("symbol", "file").agg(F.max("bytes").alias("bytes"), F.count_if(F.trim("value") != "").alias("n_lines"))
        .join(of_file.groupBy("file").agg(F.count("*").alias("n_rejects")), "file", "left")
        .withColumn("n_rejects", zero_if_missing(F.col("n_rejects")))
    )
    files.select("symbol", "file", "bytes", "n_lines", "n_rejects").write.mode("overwrite").parquet(f"{lake_root}/{LANDED}/{place}")
    return rows


def land_to_lake(
    spark: SparkSession,
    landing_root: str,
    lake_root: str,
    day: date,
    tables: tuple[str, ...] = ("SymbolInfor", "Trades", "Klines"),
) -> None:
    """The responses landed on a day, in the place of what the lake has for that day.

    A table without files that day is an empty one.
    """
    for table in tables:
        land_table(spark, landing_root, lake_root, table, day)


def land_tickers(
    spark: SparkSession,
    landing_root: str,
    lake_root: str,
    day: date,
    database: str = warehouse.WAREHOUSE_DATABASE,
) -> tuple[DataFrame, DataFrame]:
    """Land the day's tickers behind the watermark; what to fetch follows from them.

    Returns the pages of trade ids, also of those that an earlier day lost, and
    the pages of candle times.
    """
    landed = {}

    def resumed(tickers: DataFrame) -> DataFrame:
        # Read for the lake and for each plan, so it must not change in between.
        landed["tickers"] = tickers
        landed["resumed"] = pin(incremental.resume_tickers(tickers, trade_watermarks(spark, database)))
        return landed["resumed"].select(*tickers.columns)

    land_table(spark, landing_root, lake_root, "Ticker_24h", day, resumed)
    pages = incremental.missing_trade_pages(landed["tickers"], spark.table(f"`{database}`.trade_id_ranges"))
    return pages, incremental.kline_fetch_plan(landed["resumed"])


def landing_report(spark: SparkSession, lake_root: str, day: date) -> DataFrame:
    """How complete a day is, one row per table.

    ``n_missing`` counts the symbols that the day's tickers say have trades but
    that landed no file in the table; a table with some is ``half``, one without
    files is ``empty``, the others are ``whole``.
    """
    tables = spark.createDataFrame([(t,) for t in LAKE], "table string")
    files = pin(read_landed(spark, lake_root).where(F.col("day") == F.lit(day)))
    sums = files.groupBy("table").agg(
        F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"),
        F.sum("n_lines").alias("n_lines"), F.sum("n_rejects").alias("n_rejects"),
    )
    tickers = lake.read_lake_day(spark, lake_root, "Ticker_24h", day)
    traded = tickers.where("firstId >= 0 AND lastId >= firstId").select("symbol").distinct()
    # A row per table and symbol: four tables.
    wanted = traded.withColumn("table", F.explode(F.array(*(F.lit(t) for t in LAKE))))
    missing = (
        wanted.join(files.select("table", "symbol").distinct(), ["table", "symbol"], "left_anti")
        .groupBy("table").agg(F.count("*").alias("n_missing"))
    )
    counts = [zero_if_missing(F.col(c)).alias(c) for c in ("n_files", "n_bytes", "n_lines", "n_rejects", "n_missing")]
    status = F.when(F.col("n_files") == 0, "empty").when(F.col("n_missing") > 0, "half").otherwise("whole")
    return (
        tables.join(sums, "table", "left").join(missing, "table", "left").select("table", *counts)
        .withColumn("status", status)
    )
