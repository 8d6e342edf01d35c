"""The daily load as streams over new files.

Each run takes what arrived since the last one and stops. Trades are appended
batch by batch against the stored ones, which is exact however late a file
comes. Candles follow from the stored trades: every batch adds its part of each
minute it has trades of, parts are merged on reading and now and then written
together, so every stored trade is read once. Nothing waits for a watermark, no
state is kept, and a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_trades
from ..operators.derive import kline_parts, klines_from_parts, merged_parts
from ..operators.incremental import new_trades
from ..schemas import AMOUNT, PRICE, WAREHOUSE, lake_schema
from ..session import drop_folder, folder_exists, folder_names

PART_SCHEMA = (
    f"symbol string, opentime timestamp, first_key decimal(38,0), last_key decimal(38,0), openPrice {PRICE}, "
    f"highPrice {PRICE}, lowPrice {PRICE}, closePrice {PRICE}, volume {AMOUNT}, quoteassetvolume {AMOUNT}, "
    f"numberoftrades bigint, takerbaseassetvolume {AMOUNT}, takerbuyquoteassetvolume {AMOUNT}"
)
PART_COLUMNS = [part.split()[0] for part in PART_SCHEMA.split(", ")]


def read_trades(
    spark: SparkSession, lake_root: str, files_per_batch: int | None = None
) -> DataFrame:
    """Typed trades from lake files as they arrive."""
    reader = spark.readStream.schema(lake_schema("Trades"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return clean_trades(reader.parquet(f"{lake_root}/Trades"))


def stored_trades(spark: SparkSession, path: str) -> DataFrame:
    """The trades written so far; none before the first run."""
    schema = WAREHOUSE["trades"].schema
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_new_trades(
    spark: SparkSession,
    lake_root: str,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the trades that are not stored yet; a repeated batch adds nothing."""
    partitions = WAREHOUSE["trades"].partitions

    def append(batch: DataFrame, _: int) -> None:
        stored = stored_trades(batch.sparkSession, path)
        (
            new_trades(batch, stored)
            .hint("rebalance", *partitions)
            .write.partitionBy(*partitions)
            .mode("append")
            .parquet(path)
        )

    return (
        read_trades(spark, lake_root, files_per_batch)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Number of batches whose parts are written together.
COMPACT_EVERY = 16
_WHOLE, _BATCH = "upto=", "batch="


def _part_folders(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The last batch that is compacted (-1: none), and the folders that have all parts."""
    names = [n for n in folder_names(spark, path) if folder_exists(spark, f"{path}/{n}/_SUCCESS")]
    upto = max((int(n.removeprefix(_WHOLE)) for n in names if n.startswith(_WHOLE)), default=-1)
    later = [n for n in names if n.startswith(_BATCH) and int(n.removeprefix(_BATCH)) > upto]
    return upto, [f"{path}/{n}" for n in ([f"{_WHOLE}{upto}"] if upto >= 0 else []) + later]


def kline_part_rows(spark: SparkSession, path: str) -> DataFrame:
    """All parts of candles under ``path``; none before the first batch."""
    folders = _part_folders(spark, path)[1]
    if not folders:
        return spark.createDataFrame([], PART_SCHEMA)
    return spark.read.schema(PART_SCHEMA).parquet(*folders)


def stored_klines(spark: SparkSession, path: str) -> DataFrame:
    """The candles of all trades that the stream has read."""
    return klines_from_parts(kline_part_rows(spark, path))


def compact_klines(spark: SparkSession, path: str, batch: int) -> None:
    """All parts up to a batch as one table; what it is made of goes once it is there.

    A run that broke off leaves a folder without a mark of success, which
    readers pass over and the next run replaces.
    """
    upto, folders = _part_folders(spark, path)
    if batch <= upto:
        return
    rows = merged_parts(spark.read.schema(PART_SCHEMA).parquet(*folders))
    rows.write.mode("overwrite").parquet(f"{path}/{_WHOLE}{batch}")
    for folder in folders:
        drop_folder(spark, folder)


def load_new_klines(
    spark: SparkSession,
    trades_path: str,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Add the parts that newly stored trades have in their candles; read them with ``stored_klines``.

    A batch writes a folder of its own, so a repeated one replaces its parts.
    Batches are numbered by the checkpoint: a new checkpoint reads all trades
    again and needs a new ``path``.
    """
    if folder_names(spark, path) and not folder_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"the candles in {path} belong to another checkpoint")
    reader = spark.readStream.schema(WAREHOUSE["trades"].schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if number <= _part_folders(session, path)[0]:
            return  # repeated after it was compacted
        kline_parts(batch).select(*PART_COLUMNS).write.mode("overwrite").parquet(f"{path}/{_BATCH}{number}")
        if number % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact_klines(session, path, number)

    return (
        reader.parquet(trades_path)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
