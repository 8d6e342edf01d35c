from __future__ import annotations

from decimal import Decimal

import data

from candlemill.operators import clean, filters, keys
from candlemill.schemas import FILTER_TYPES

PRICE = {"filterType": "PRICE_FILTER", "maxPrice": "9", "minPrice": "1", "tickSize": "0.01"}
LOT = {"filterType": "LOT_SIZE", "maxQty": "46116860414.00", "minQty": "1", "stepSize": "1"}


def versioned(spark, rows):
    return keys.assign_versions(clean.clean_symbols(data.raw_symbol(spark, rows)), None)


def test_every_type_gives_one_table(spark):
    exploded = filters.explode_filters(versioned(spark, [("A", 1, [PRICE, LOT])]))
    details = filters.filter_details(exploded)
    assert len(details) == len(FILTER_TYPES) == 9
    assert details["price_filter_detail"].collect()[0].maxPrice == 9
    assert details["lot_size_filter_detail"].collect()[0].maxQty == Decimal("46116860414")
    assert details["notional_filter_detail"].count() == 0


def test_unknown_type_is_ignored_and_repeated_type_kept(spark):
    rows = [("A", 1, [PRICE, PRICE, {"filterType": "OTHER", "limit": "1"}])]
    exploded = filters.explode_filters(versioned(spark, rows))
    assert exploded.count() == 3
    assert filters.filter_detail(exploded, "PRICE_FILTER").count() == 2
    matrix = filters.filter_matrix(exploded).collect()[0]
    assert (matrix.price_filter, matrix.lot_size_filter) == (2, 0)


def test_missing_key_is_null_and_types_are_cast(spark):
    notional = {"filterType": "NOTIONAL", "minNotional": "10", "applyMinToMarket": "true"}
    exploded = filters.explode_filters(versioned(spark, [("A", 1, [notional])]))
    row = filters.filter_detail(exploded, "NOTIONAL").collect()[0]
    assert row.applyMinToMarket is True and row.applyMaxToMarket is None
    assert row.maxNotional is None and row.filter_type_id == 1


def test_empty_filters_give_no_rows(spark):
    assert filters.explode_filters(versioned(spark, [("A", 1, [])])).count() == 0


def test_same_load_twice_is_one_version_and_latest_wins(spark):
    turned = dict(reversed(PRICE.items()))
    rows = [("A", 1, [PRICE]), ("A", 1, [turned]), ("A", 2, [LOT], "BREAK"), ("B", 1, [])]
    v = versioned(spark, rows)
    assert data.rows(v.select("symbol", "filterstype_id")) == [("A", 1), ("A", 2), ("B", 1)]
    current = {r.symbol: r for r in filters.current_versions(v).collect()}
    assert current["A"].status == "BREAK" and current["A"].filters == [LOT]
