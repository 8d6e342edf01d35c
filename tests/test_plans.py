"""The physical plans are the ones meant, and the package stays set based."""

from __future__ import annotations

import re
from pathlib import Path

import data
import pytest
from data import T0

from candlemill import session
from candlemill.operators import derive, incremental, keys
from candlemill.queries import registered
from candlemill.session import checkpoint_root, pin

SF = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parent.parent / "candlemill"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", text))


def test_report_filter_and_columns_reach_the_scan(spark):
    text = plan(registered()["daily_trade_counts"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-14T12:00)" in text
    assert "LessThan(ts,2024-01-15T12:00:01)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert shuffles(text) == 1


@pytest.mark.parametrize("name", ["klines_from_trades", "lineitem_trade_counts", "latest_order_id"])
def test_aggregates_hash_and_shuffle_once(spark, name):
    text = plan(registered()[name](spark, SF))
    assert "partial_" in text and "HashAggregate" in text and "SortAggregate" not in text
    assert shuffles(text) == 1


def test_small_lookup_is_broadcast_and_large_one_is_salted(spark):
    t = data.trades(spark, [("A", 1, "1", "1", T0)])
    latest = keys.latest_ids(t, "trade_id")
    assert "BroadcastHashJoin" in plan(incremental.after_watermark(t, latest))
    text = keys.attach_per_symbol(t, latest, "trade_id", broadcast_rows=0)
    assert "_salt" in text._jdf.queryExecution().optimizedPlan().toString()


def test_ids_do_not_shuffle_rows_after_they_are_written(spark):
    t = data.trades(spark, [("A", i, "1", "1", T0) for i in range(9)])
    text = plan(keys.sequential_ids(t, ["symbol"], ["trade_id"], "n"))
    assert "BroadcastHashJoin" in text and shuffles(text) == 0


def test_candle_order_is_a_number(spark):
    t = data.trades(spark, [("A", 1, "1", "1", T0)])
    text = plan(derive.ticker_from_trades(t, T0))
    assert "SortAggregate" not in text


def test_pinned_rows_lie_in_the_named_folder(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert all(root in f for f in pin(spark.range(3)).inputFiles())


def test_scratch_is_dropped_on_request_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_scratch_root", lambda _: str(tmp_path / "own"))
    pinned = pin(spark.range(3))
    assert pinned.count() == 3 and list((tmp_path / "own").iterdir())
    (tmp_path / "other").mkdir()
    session.drop_scratch(spark)
    assert [f.name for f in tmp_path.iterdir()] == ["other"]


def test_a_dropped_lake_is_written_again(spark):
    counts = registered()["lake_row_counts"]
    assert counts(spark, SF).count() == 5
    session.drop_scratch(spark)
    assert counts(spark, SF).count() == 5


def test_package_neither_collects_nor_uses_udfs():
    banned = (
        r"\.collect\(", r"\.toPandas\(", r"localCheckpoint", r"\budf\b", r"pandas_udf",
        r"\.rdd\b", r"crossJoin", r"datetime\.now", r"date\.today",
    )
    for file in PACKAGE.rglob("*.py"):
        if "llm" in file.parts:
            continue  # that subpackage may use Arrow functions and fits models
        text = file.read_text()
        for pattern in banned:
            assert not re.search(pattern, text), (file.name, pattern)
