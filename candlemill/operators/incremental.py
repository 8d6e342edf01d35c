"""Incremental loads: watermarks, fetch plans, and appends that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import zero_if_missing
from .keys import attach_per_symbol, sequential_ids

TRADES_PER_PAGE = 1000
KLINES_PER_PAGE_MS = 12 * 60 * 60 * 1000
PAGES_PER_BLOCK = 10_000


def after_watermark(batch: DataFrame, latest: DataFrame) -> DataFrame:
    """Trades with an id above the last stored one of their symbol."""
    return (
        attach_per_symbol(batch, latest, spread_by="trade_id")
        .where(F.col("trade_id") > F.coalesce("latest_id", F.lit(-1)))
        .drop("latest_id")
    )


def resume_tickers(tickers: DataFrame, latest: DataFrame) -> DataFrame:
    """``firstId`` moved behind the last stored trade, and the counts that follow.

    ``count`` is ``lastId - firstId``; ``count_inclusive`` counts both ends and
    is never negative. A stored id of 0 counts as none.
    """
    stored = zero_if_missing(F.col("latest_id"))
    first = F.when(stored == 0, F.col("firstId")).otherwise(stored + 1)
    return (
        tickers.join(latest, "symbol", "left")
        .withColumn("firstId", first)
        .withColumn("count", F.col("lastId") - F.col("firstId"))
        .withColumn("count_inclusive", F.greatest(F.col("count") + 1, F.lit(0)))
        .drop("latest_id")
    )


def valid_tickers(tickers: DataFrame) -> DataFrame:
    """Tickers whose trades can be fetched: both ids above 0."""
    return tickers.where((F.col("firstId") > 0) & (F.col("lastId") > 0))


def _page_starts(df: DataFrame, first: str, last: str, step: int, alias: str) -> DataFrame:
    """One row per page start in ``[first, last]``.

    Long ranges are first cut into blocks and the blocks spread over the
    cluster, so no single row expands into an unbounded array.
    """
    block = step * PAGES_PER_BLOCK
    return (
        df.where(F.col(first) <= F.col(last))
        .withColumn("_block", F.explode(F.sequence(first, last, F.lit(block).cast("bigint"))))
        .repartition("symbol", "_block")
        .withColumn(
            alias,
            F.explode(
                F.sequence(
                    "_block",
                    F.least(F.col("_block") + F.lit(block - 1), F.col(last)),
                    F.lit(step).cast("bigint"),
                )
            ),
        )
        .drop("_block")
    )


def trade_fetch_plan(tickers: DataFrame, step: int = TRADES_PER_PAGE) -> DataFrame:
    """Id pages to fetch per symbol: start and end id, both inclusive."""
    # Id 0 is a trade; only -1 means that there are none.
    valid = tickers.where("firstId >= 0 and lastId >= 0").select("symbol", "firstId", "lastId")
    return _page_starts(valid, "firstId", "lastId", step, "from_id").select(
        "symbol",
        "from_id",
        F.least(F.col("from_id") + F.lit(step - 1), F.col("lastId")).alias("to_id"),
    )


def id_ranges(trades: DataFrame) -> DataFrame:
    """Runs of trade ids without a hole: (symbol, first_id, last_id).

    Ids less their place in the order are equal in a run. The places come from
    range partitions, so no task has all ids of a symbol.
    """
    ids = trades.select("symbol", "trade_id").dropna().distinct()
    placed = sequential_ids(ids, ["symbol"], ["trade_id"], "place")
    runs = placed.groupBy("symbol", (F.col("trade_id") - F.col("place")).alias("run")).agg(
        F.min("trade_id").alias("first_id"), F.max("trade_id").alias("last_id")
    )
    return runs.drop("run")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or touch, as one; from one row per run, not per trade."""
    earlier = W.partitionBy("symbol").orderBy("first_id", "last_id")
    reach = F.max("last_id").over(earlier.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first_id") > reach + 1), 1).otherwise(0)
    runs = ranges.withColumn("new", new).withColumn(
        "run", F.sum("new").over(earlier.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    return (
        runs.groupBy("symbol", "run")
        .agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
        .select("symbol", "first_id", "last_id")
    )


def missing_ranges(tickers: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids up to each ticker's last one that no stored range has: (symbol, first_id, last_id).

    They begin at the ticker's first id or at the least stored one, so pages
    that were lost on an earlier day are among them.
    """
    wanted = tickers.where("firstId >= 0 and lastId >= 0").groupBy("symbol").agg(
        F.min("firstId").alias("start"), F.max("lastId").alias("stop")
    )
    after = wanted.select("symbol", (F.col("stop") + 1).alias("first_id"), (F.col("stop") + 1).alias("last_id"))
    have = merged_ranges(stored.select("symbol", "first_id", "last_id")).unionByName(after)
    earlier = W.partitionBy("symbol").orderBy("first_id", "last_id").rowsBetween(W.unboundedPreceding, -1)
    return (
        have.join(wanted, "symbol")
        .withColumn("low", F.coalesce(F.max("last_id").over(earlier) + 1, "start"))
        .select("symbol", F.col("low").alias("first_id"), F.least(F.col("first_id") - 1, F.col("stop")).alias("last_id"))
        .where("first_id <= last_id")
    )


def missing_trade_pages(tickers: DataFrame, stored: DataFrame, step: int = TRADES_PER_PAGE) -> DataFrame:
    """Pages to fetch: exactly the missing ids, each page within one hole. Both ends are inclusive."""
    holes = missing_ranges(tickers, stored)
    return _page_starts(holes, "first_id", "last_id", step, "from_id").select(
        "symbol", "from_id", F.least(F.col("from_id") + F.lit(step - 1), F.col("last_id")).alias("to_id")
    )


def kline_fetch_plan(tickers: DataFrame, step: int = KLINES_PER_PAGE_MS) -> DataFrame:
    """Time pages to fetch per symbol, in epoch milliseconds, both inclusive."""
    spans = tickers.select("symbol", "openTime", "closeTime")
    return _page_starts(spans, "openTime", "closeTime", step, "from_ms").select(
        "symbol",
        "from_ms",
        F.least(F.col("from_ms") + F.lit(step - 1), F.col("closeTime")).alias("to_ms"),
    )


def concat_pages(pages: list[DataFrame]) -> DataFrame:
    """All rows of all pages, duplicates kept."""
    whole, *rest = pages
    for page in rest:
        whole = whole.unionByName(page)
    return whole


def with_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known; NULL keys would match nothing and pile up."""
    return batch.dropna(subset=keys)


def new_trades(batch: DataFrame, stored: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Trades of the batch, once each, that are not stored yet.

    A trade's day never changes, so only stored days that the batch touches
    (``days``, if they are known) are read, found by a semi-join on the partition
    column. Rows without a key, such as those of broken lines, are no trades and
    never stored.
    """
    keys = ["symbol", "trade_date", "trade_id"]
    batch = with_keys(batch, keys)
    touched = batch.select("trade_date").distinct() if days is None else days
    days = stored.join(touched, "trade_date", "left_semi")
    return batch.dropDuplicates(keys).join(days.select(*keys), keys, "left_anti")


def fullest_klines(batch: DataFrame) -> DataFrame:
    """Candles once per symbol and open time: the row with most trades.

    Overlapping pages may hold one candle twice; the one with more trades is
    the more complete one.
    """
    keys = ["symbol", "opentime"]
    batch = with_keys(batch, keys)
    rest = [c for c in batch.columns if c not in keys]
    fullest = F.max(F.struct("numberoftrades", *(c for c in rest if c != "numberoftrades")))
    once = batch.groupBy(*keys).agg(fullest.alias("row")).select(*keys, "row.*")
    return once.select(*batch.columns)


def changed_klines(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Candles of the batch that are not stored yet or fuller than the stored ones.

    The latter keep their ``kline_id``, new ones have none. Only stored days
    (``open_date``) that the batch touches are read.
    """
    keys = ["symbol", "open_date", "opentime"]
    once = fullest_klines(batch)
    days = stored.join(once.select("open_date").distinct(), "open_date", "left_semi")
    old = days.select(*keys, "kline_id", F.col("numberoftrades").alias("_stored"))
    return (
        once.join(old, keys, "left")
        .where(F.col("_stored").isNull() | (F.col("numberoftrades") > F.col("_stored")))
        .select(*batch.columns, "kline_id")
    )


def new_klines(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Candles of the batch, once per symbol and open time, not stored yet."""
    keys = ["symbol", "opentime"]
    batch = with_keys(batch, keys)
    seconds = F.unix_seconds("opentime")
    low, high = batch.agg(F.min(seconds), F.max(seconds)).first()
    span = stored.where(
        F.col("opentime").between(
            F.timestamp_seconds(F.lit(low).cast("bigint")),
            F.timestamp_seconds(F.lit(high).cast("bigint")),
        )
    )
    once = fullest_klines(batch)
    return once.join(span.select(*keys), keys, "left_anti").select(*batch.columns)


def new_rows(batch: DataFrame, stored: DataFrame, keys: list[str], day: str | None = None) -> DataFrame:
    """Rows of a small batch, once per key, that are not stored yet.

    With ``day``, a key that the stored table is partitioned by, only the days of
    the batch are read.
    """
    batch = with_keys(batch, keys)
    if day:
        stored = stored.join(batch.select(day).distinct(), day, "left_semi")
    return batch.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti")
