"""Exchange responses kept as JSON files, read with declared schemas.

Files lie under ``{root}/{table}/day=YYYY-MM-DD/symbol=S/``. A line is one record or one page
(a JSON array of records; a candle record is itself an array). What is no record is
kept with its file and line: a line that isn't JSON as a whole, a record that doesn't
fit the schema, and a record without its key each count as one reject.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import zero_if_missing
from ..schemas import LAKE

KLINE_PAGE = "array<array<string>>"
#: A candle has this many fields; the twelfth is unused.
KLINE_FIELDS = 11
#: Fields without which a record is of no use.
REQUIRED = {
    "SymbolInfor": ("status",),
    "Trades": ("id", "time"),
    "Klines": ("_1",),
    "Ticker_24h": ("firstId",),
}
BROKEN, NO_KEY = "broken", "no key"
LINE = "value string, symbol string"
REJECT = "symbol string, file string, line bigint, record int, reason string, text string"
_PLACE = ("symbol", "file", "block", "at", "record")


def parse_record(text: Column, table: str) -> Column:
    """One JSON object as a struct of the table's raw fields."""
    return F.from_json(text, LAKE[table])


def parse_page(text: Column, table: str) -> Column:
    """A JSON array of objects as an array of structs."""
    return F.from_json(text, f"array<struct<{_struct_fields(table)}>>")


def kline_struct(fields: Column) -> Column:
    """The texts of a candle's fields as a struct ``_1`` … ``_12``; NULL what doesn't fit."""
    declared = T.StructType.fromDDL(LAKE["Klines"]).fields
    return F.struct(
        *(F.get(fields, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(declared))
    )


def parse_kline_page(text: Column) -> Column:
    """A JSON array of candle arrays as an array of structs ``_1`` … ``_12``."""
    return F.transform(F.from_json(text, KLINE_PAGE), kline_struct)


def _struct_fields(table: str) -> str:
    schema = T.StructType.fromDDL(LAKE[table])
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in schema)


def landed_lines(spark: SparkSession, root: str, table: str, day: date) -> DataFrame:
    """Lines landed on a day with their place: file, its size, block of the file, and order in the scan.

    Without a folder of that day there are no lines.
    """
    try:
        text = spark.read.schema(LINE).text(f"{root}/{table}/day={day}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{LINE}, file string, bytes bigint, block bigint, at bigint")
    return text.select(
        "value",
        "symbol",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def records(lines: DataFrame, table: str) -> DataFrame:
    """One row per record of the lines: its place, ``row`` (a struct of the raw fields), ``reason`` and ``text``.

    ``reason`` is NULL for a good record. A page that isn't JSON as a whole is one
    broken record, an empty page has none. Unquoted decimals of objects in a page
    pass through a double; the exchange sends decimals as text. Blank lines are none.
    """
    lines = lines.where(F.trim("value") != "")
    if table == "Klines":
        one = F.from_json("value", "array<string>")
        page = F.when(F.col("value").rlike(r"^\s*\[\s*\["), F.from_json("value", KLINE_PAGE)).when(
            F.size(one) > 0, F.array(one)
        )
        parts = F.when(F.size(one) == 0, F.slice(F.array(one), 1, 0)).otherwise(F.coalesce(page, F.array(F.lit(None).cast("array<string>"))))
        each = lines.select("*", F.posexplode(parts).alias("record", "fields"))
        numbers = [i for i, f in enumerate(T.StructType.fromDDL(LAKE[table])) if isinstance(f.dataType, T.LongType)]
        unfit = F.lit(False)
        for i in numbers:
            field = F.get("fields", F.lit(i))
            unfit |= field.isNotNull() & field.try_cast("bigint").isNull()
        broken = F.col("fields").isNull() | (F.size("fields") < KLINE_FIELDS) | unfit
        parsed = each.select(
            *_PLACE, kline_struct(F.col("fields")).alias("row"), broken.alias("broken"),
            F.coalesce(F.to_json("fields"), "value").alias("text"),
        )
    else:
        page = F.from_json("value", "array<string>")
        each = lines.select("*", F.posexplode(F.coalesce(page, F.array("value"))).alias("record", "text"))
        schema = f"{LAKE[table]}, _broken string"
        found = each.withColumn("found", F.from_json("text", schema, {"columnNameOfCorruptRecord": "_broken"}))
        names = T.StructType.fromDDL(LAKE[table]).fieldNames()
        is_object = zero_if_missing(F.instr(F.ltrim("text"), "{")) == 1
        parsed = found.select(
            *_PLACE, F.struct(*(F.col(f"found.{n}").alias(n) for n in names)).alias("row"),
            (~is_object | F.col("found").isNull() | F.col("found._broken").isNotNull()).alias("broken"),
            F.coalesce("text", "value").alias("text"),
        )
    lacking = F.lit(False)
    for name in REQUIRED[table]:
        lacking |= F.col(f"row.{name}").isNull()
    reason = F.when(F.col("broken"), BROKEN).when(lacking, NO_KEY)
    return parsed.select(*_PLACE, "row", reason.alias("reason"), "text")


def good_records(found: DataFrame) -> DataFrame:
    """The raw rows of the records that are fit for the lake."""
    return found.where("reason IS NULL").select("row.*", "symbol")


def rejected(found: DataFrame, lines: DataFrame) -> DataFrame:
    """Rejected records by file and line (REJECT), lines counted from 1.

    A large file is read in blocks; the lines of its earlier blocks are added up.
    """
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first_at"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first_at", zero_if_missing(F.sum("n").over(earlier)).alias("before"))
    line = F.col("before") + F.col("at") - F.col("first_at") + 1
    return (
        found.where("reason IS NOT NULL")
        .join(starts, ["file", "block"])
        .select("symbol", "file", line.alias("line"), F.col("record").cast("int").alias("record"), "reason", "text")
    )


def read_landing(spark: SparkSession, root: str, table: str, day: date) -> DataFrame:
    """The good records of a table landed on a day, with their symbol from the path."""
    return good_records(records(landed_lines(spark, root, table, day), table))
