from __future__ import annotations

import random

import data
from data import T0
from pyspark.sql import functions as F

from candlemill.operators import keys


def numbered(rows):
    """Row numbers per group, by brute force."""
    out, seen = {}, {}
    for group, order in sorted(rows):
        seen[group] = seen.get(group, 0) + 1
        out[(group, order)] = seen[group]
    return out


def test_ids_are_dense_with_a_dominant_group(spark):
    rng = random.Random(7)
    rows = [("hot", i) for i in rng.sample(range(10**6), 3000)]
    rows += [(f"s{rng.randrange(400)}", i) for i in rng.sample(range(10**6), 6000)]
    df = spark.createDataFrame(rows, "g string, o bigint").repartition(8)
    got = keys.sequential_ids(df, ["g"], ["o"], "id")
    assert {(r.g, r.o): r.id for r in got.collect()} == numbered(rows)


def test_the_dominant_group_is_spread_over_partitions(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    ranged = df.repartitionByRange(8, "g", "o")
    sizes = [r[1] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_ids_without_group_and_with_null_group(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "o string")
    assert data.rows(keys.sequential_ids(df, [], ["o"], "id")) == [("a", 1), ("b", 2), ("c", 3)]
    df = spark.createDataFrame([(None, 2), (None, 1), ("x", 5)], "g string, o int")
    got = {(r.g, r.o): r.id for r in keys.sequential_ids(df, ["g"], ["o"], "id").collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("x", 5): 1}


def test_ids_continue_from_the_latest(spark):
    batch = spark.createDataFrame([("A", 5), ("A", 3), ("B", 9)], "symbol string, o int")
    latest = spark.createDataFrame([("A", 40)], "symbol string, latest_id bigint")
    got = keys.sequential_ids(batch, ["symbol"], ["o"], "id", latest)
    assert data.rows(got) == [("A", 3, 41), ("A", 5, 42), ("B", 9, 1)]


def test_salted_lookup_equals_broadcast_lookup(spark):
    facts = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7))
        .alias("symbol"),
        "id",
    )
    dim = facts.select("symbol").distinct().where("symbol <> 's2'").withColumn("v", F.length("symbol"))
    small = keys.attach_per_symbol(facts, dim, "id")
    large = keys.attach_per_symbol(facts, dim, "id", broadcast_rows=0)
    assert large.columns == small.columns
    assert data.rows(small) == data.rows(large) and small.count() == 500


def test_symbol_ids_never_change(spark):
    none = spark.createDataFrame([], "symbol_id bigint, symbol string")
    day1 = spark.createDataFrame([("C",), ("A",), ("A",)], "symbol string")
    dim = keys.extend_symbol_dim(day1, none)
    assert data.rows(dim) == [(1, "A"), (2, "C")]
    day2 = spark.createDataFrame([("B",), ("C",)], "symbol string")
    both = dim.unionByName(keys.extend_symbol_dim(day2, dim))
    assert data.rows(both) == [(1, "A"), (2, "C"), (3, "B")]
    assert keys.extend_symbol_dim(day2, both).count() == 0
    assert data.rows(keys.first_symbols(both, 2)) == [(1, "A"), (2, "C")]


def test_unknown_symbol_has_id_zero(spark):
    dim = spark.createDataFrame([(1, "A")], "symbol_id bigint, symbol string")
    facts = spark.createDataFrame([("A", 1), ("Z", 2)], "symbol string, trade_id bigint")
    got = keys.with_symbol_id(facts, dim, "trade_id").select("symbol", "symbol_id")
    assert data.rows(got) == [("A", 1), ("Z", 0)]


def test_latest_and_top(spark):
    t = data.trades(spark, [("A", 4, "1", "1", T0), ("A", 9, "1", "1", T0), ("B", 2, "1", "1", T0)])
    assert data.rows(keys.latest_ids(t, "trade_id")) == [("A", 9), ("B", 2)]
    assert keys.top_by(t, "trade_id").collect()[0].trade_id == 9


def test_only_hot_symbols_are_spread(spark):
    """The large branch, with a symbol that has most rows: every task has its share."""
    facts = spark.range(60_000).selectExpr("id AS trade_id", "IF(id % 5 < 2, 'HOT', concat('S', id % 4000)) AS symbol")
    ids = spark.range(4000).selectExpr("concat('S', id) AS symbol", "id AS symbol_id").union(spark.sql("SELECT 'HOT', 9999L"))
    assert [r.symbol for r in keys.hot_symbols(facts, fraction=0.5).collect()] == ["HOT"]
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        joined = keys.attach_per_symbol(facts, ids, "trade_id", broadcast_rows=0, fraction=0.5)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.where("symbol = 'HOT' AND symbol_id = 9999").count() == 24_000
        assert joined.where("symbol_id IS NULL").count() == 0 and sum(sizes) == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
