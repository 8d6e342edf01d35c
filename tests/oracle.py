"""Side-by-side comparison of a Spark result with SQL run by DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con



def compare(spark_df, con, sql: str) -> tuple[list[str], list[str], list, list]:
    """Column names, and rows with columns ordered by name and rows sorted."""
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    spark_names = spark_df.columns
    spark_rows = spark_df.collect()
    order = sorted(spark_names)
    left = [tuple(row[spark_names.index(n)] for n in order) for row in spark_rows]
    if sorted(sql_names) != order:
        return spark_names, sql_names, left, sql_rows
    right = [tuple(row[sql_names.index(n)] for n in order) for row in sql_rows]
    return spark_names, sql_names, sorted(left, key=repr), sorted(right, key=repr)
