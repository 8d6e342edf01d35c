"""Warehouse and report tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import BOOKS, REPORTS, WAREHOUSE, Table, create_table_sql

# Fixed value: dashboards read the report tables from this database.
REPORT_DATABASE = "changes_daily"
WAREHOUSE_DATABASE = "market_data"


def create_database(spark: SparkSession, database: str, folder: str | None = None) -> None:
    """A database in the warehouse, or in a folder of its own."""
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"USE `{database}`")


def create_tables(spark: SparkSession, database: str, tables: dict[str, Table]) -> None:
    create_database(spark, database)
    for name, table in tables.items():
        spark.sql(create_table_sql(database, name, table))


def create_warehouse(spark: SparkSession, database: str = WAREHOUSE_DATABASE) -> None:
    create_tables(spark, database, WAREHOUSE | BOOKS)


def create_reports(spark: SparkSession, database: str = REPORT_DATABASE) -> None:
    create_tables(spark, database, REPORTS)


def laid_out(df: DataFrame, name: str) -> DataFrame:
    """Columns and rows as the table keeps them.

    Rows are rebalanced by partition, so a partition is a few well-sized files
    and a dominant symbol is split over several tasks; sorting inside the files
    lets later reads skip row groups.
    """
    table = WAREHOUSE[name]
    rows = df.select(*(f.name for f in table.schema))
    if table.buckets:
        # A partition has one file for each bucket.
        return rows.repartition(table.buckets, *table.order).sortWithinPartitions(*table.partitions, *table.order)
    if not table.partitions:
        return rows
    return rows.hint("rebalance", *table.partitions).sortWithinPartitions(
        *table.partitions, *table.order
    )


def append(df: DataFrame, database: str, name: str) -> None:
    """Append to a table: one write for all symbols."""
    laid_out(df, name).write.insertInto(f"`{database}`.`{name}`")


def note(rows: DataFrame, database: str, name: str) -> None:
    """Append a few rows to a table of the loads' books, in one file."""
    rows.select(*(f.name for f in BOOKS[name].schema)).coalesce(1).write.insertInto(f"`{database}`.`{name}`")


def insert_partition(df: DataFrame, table: str, partition: dict[str, str]) -> None:
    """``INSERT … PARTITION (k = v) SELECT``: rows for one named partition."""
    spark = df.sparkSession
    values = ", ".join(f"`{k}` = :{k}" for k in partition)
    stored = [c for c in spark.table(table).columns if c not in partition]
    spark.sql(
        f"INSERT INTO {table} PARTITION ({values}) SELECT * FROM {{rows}}",
        args=partition,
        rows=df.select(*stored),
    )


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions that occur in ``df``; the table's own option says so."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)


def full_refresh(df: DataFrame, table: str) -> None:
    """Replace a report table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
