"""What loads note about themselves: begin and end, the ids they gave, what did not fit.

The greatest ids come from a small table instead of the loaded one. That table is
trusted only if the last load of the table has ended; after one that broke off the
loaded table is read once and the marks are made anew.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import reject_counts
from ..operators import keys
from ..session import pin
from ..sources import warehouse

BEGUN, ENDED = "begun", "ended"
#: After this many loads of a table its marks and log are written together.
COMPACT_EVERY = 32


@dataclass(frozen=True)
class Load:
    """One load of a table into a database."""

    spark: SparkSession
    database: str
    table: str
    day: date
    number: int
    #: Whether the load before ended, so that its marks can be trusted.
    follows_end: bool

    def book(self, name: str) -> DataFrame:
        """What a book says of this table."""
        return self.spark.table(f"`{self.database}`.{name}").where(F.col("table_name") == self.table)

    def _note_phase(self, phase: str) -> None:
        rows = self.spark.createDataFrame(
            [(self.number, phase, self.day, self.table)], "load_no bigint, phase string, load_date date, table_name string"
        )
        warehouse.note(rows, self.database, "load_log")

    def latest_ids(self, id_column: str) -> DataFrame:
        """Greatest id per symbol, from the marks or, after a load that broke off, from the table."""
        if self.follows_end:
            return keys.latest_ids(self.book("id_marks"), "latest_id")
        found = pin(keys.latest_ids(self.spark.table(f"`{self.database}`.`{self.table}`"), id_column))
        warehouse.overwrite_partitions(self._marks(found), f"`{self.database}`.id_marks")
        return found

    def _marks(self, latest: DataFrame) -> DataFrame:
        return latest.select(
            "symbol", "latest_id", F.lit(self.number).cast("long").alias("load_no"), F.lit(self.table).alias("table_name")
        )

    def note_ids(self, rows: DataFrame, id_column: str) -> None:
        """The greatest ids this load gave."""
        given = rows.groupBy("symbol").agg(F.max(id_column).alias("latest_id"))
        warehouse.note(self._marks(given), self.database, "id_marks")

    def note_rejects(self, counts: dict[str, int]) -> None:
        """Values that did not fit, by column; rows without a key with a NULL column. Replaces those of the day."""
        found = dict(counts)
        n_rows = found.pop("n_rows")
        rows = self.spark.createDataFrame(
            [(None if name == "no key" else name, n_rows, n, self.table, self.day) for name, n in sorted(found.items())],
            "column_name string, n_rows bigint, n_rejects bigint, table_name string, load_date date",
        )
        warehouse.overwrite_partitions(rows.coalesce(1), f"`{self.database}`.load_rejects")

    def end(self) -> None:
        """The load is whole; now and then the books are written together."""
        if self.number % COMPACT_EVERY == 0:
            marks = pin(keys.latest_ids(self.book("id_marks"), "latest_id"))
            warehouse.overwrite_partitions(self._marks(marks).coalesce(1), f"`{self.database}`.id_marks")
            log = pin(self.book("load_log").where(F.col("load_no") == self.number))
            warehouse.overwrite_partitions(log.coalesce(1), f"`{self.database}`.load_log")
        self._note_phase(ENDED)


def begin(spark: SparkSession, database: str, table: str, day: date) -> Load:
    """Note that a load begins; only then may it change the table."""
    log = spark.table(f"`{database}`.load_log").where(F.col("table_name") == table)
    begun, ended = log.agg(
        F.max(F.when(F.col("phase") == BEGUN, F.col("load_no"))), F.max(F.when(F.col("phase") == ENDED, F.col("load_no")))
    ).first()
    load = Load(spark, database, table, day, (begun or 0) + 1, begun is not None and begun == ended)
    load._note_phase(BEGUN)
    return load


def observed(raw: DataFrame, types: dict[str, str], required: list[str], of_table: str) -> tuple[DataFrame, Observation]:
    """``raw`` with counts of values that don't fit and rows without a key, taken in the scan of the load itself.

    They are there once the cleaned rows are pinned (behind a join that leaves
    nothing they could get lost). Tasks that run again after an executor is lost
    may be counted again.
    """
    seen = Observation(f"load of {of_table}")
    lacking = F.lit(False)
    for name in required:
        lacking |= F.col(name).isNull()
    counts = [c.alias(name) for name, c in reject_counts(types).items()]
    return raw.observe(seen, F.count("*").alias("n_rows"), F.count_if(lacking).alias("no key"), *counts), seen
