"""The registered queries as plain SQL, for comparison by another engine."""

from __future__ import annotations

from .queries import FILTER_KEYS
from .schemas import FILTER_TYPES


def _r(expression: str, alias: str) -> str:
    return f'CAST({expression} AS DOUBLE) AS "{alias}"'


def _half_up(numerator: str, denominator: str) -> str:
    """Quotient of two values with four decimals, rounded half up to ten."""
    n = f"CAST(CAST({numerator} AS DECIMAL(30,4)) * 10000 AS HUGEINT) * 10000000000"
    d = f"CAST(CAST({denominator} AS DECIMAL(30,4)) * 10000 AS HUGEINT)"
    return (
        f"CASE WHEN {denominator} = 0 THEN NULL ELSE CAST(sign({numerator}) * "
        f"((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / 10000000000 END"
    )


def trades(symbol: str = "event_type", source: str = "events") -> str:
    return f"""t AS (
  SELECT event_id AS trade_id, user_id % 2 = 0 AS maker, price, qty, price * qty AS quote,
         date_trunc('second', ts) AS trade_time, CAST({symbol} AS VARCHAR) AS symbol, ts
  FROM (SELECT *, CAST(value AS DECIMAL(12,4)) AS price,
               CAST(CAST(props->>'$.k' AS BIGINT) AS DECIMAL(10,0)) AS qty FROM {source}))"""


ORDER_TRADES = """t AS (
  SELECT o_orderkey AS trade_id, o_orderstatus = 'F' AS maker,
         CAST(o_totalprice AS DECIMAL(14,4)) AS price, CAST(1 AS DECIMAL(10,0)) AS qty,
         CAST(o_totalprice AS DECIMAL(14,4)) AS quote, o_orderdate AS trade_time,
         o_orderpriority AS symbol
  FROM orders)"""

KLINES = """k AS (
  SELECT symbol, date_trunc('minute', trade_time) AS opentime,
         arg_min(price, (trade_time, trade_id)) AS o, max(price) AS h, min(price) AS l,
         arg_max(price, (trade_time, trade_id)) AS c, sum(qty) AS v, sum(quote) AS qv,
         count(*) AS n,
         sum(CASE WHEN maker THEN 0 ELSE qty END) AS tb,
         sum(CASE WHEN maker THEN 0 ELSE quote END) AS tq
  FROM t GROUP BY symbol, date_trunc('minute', trade_time))"""

KLINE_COLUMNS = f"""symbol, opentime, {_r('o', 'openPrice')}, {_r('h', 'highPrice')},
  {_r('l', 'lowPrice')}, {_r('c', 'closePrice')}, {_r('v', 'volume')},
  opentime + INTERVAL 59 SECOND AS closetime, {_r('qv', 'quoteassetvolume')},
  n AS numberoftrades, {_r('tb', 'takerbaseassetvolume')},
  {_r('tq', 'takerbuyquoteassetvolume')}"""


def ticker(start: str, end: str) -> str:
    return f"""d AS (
  SELECT symbol, arg_min(price, (trade_time, trade_id)) AS o, max(price) AS h,
         min(price) AS l, arg_max(price, (trade_time, trade_id)) AS c, sum(qty) AS v,
         sum(quote) AS qv, min(trade_id) AS first_id, max(trade_id) AS last_id, count(*) AS n
  FROM t WHERE trade_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}' GROUP BY symbol),
p AS (
  SELECT symbol, arg_max(price, (trade_time, trade_id)) AS prev
  FROM t WHERE trade_time < TIMESTAMP '{start}' GROUP BY symbol),
w AS (
  SELECT d.*, p.prev, TIMESTAMP '{start}' AS open_time, TIMESTAMP '{end}' AS close_time
  FROM d LEFT JOIN p ON d.symbol = p.symbol)"""


TICKER_VALUES = f"""symbol, {_r('c - o', 'priceChange')},
  {_r(_half_up('((c - o) * 100)', 'o'), 'priceChangePercent')},
  {_r(_half_up('qv', 'v'), 'weightedAvgPrice')},
  {_r('prev', 'prevClosePrice')}, {_r('c', 'lastPrice')}, {_r('o', 'openPrice')},
  {_r('h', 'highPrice')}, {_r('l', 'lowPrice')}, {_r('v', 'volume')},
  open_time AS "openTime", close_time AS "closeTime" """

TICKER_COLUMNS = (
    TICKER_VALUES + ', first_id AS "firstId", last_id AS "lastId", n AS "count"'
)

WINDOW = "BETWEEN TIMESTAMP '2024-01-14 12:00:00' AND TIMESTAMP '2024-01-15 12:00:00'"
MIDNIGHT = "TIMESTAMP '2024-01-15 00:00:00'"
DAY = ticker("2024-01-14 12:00:00", "2024-01-15 12:00:00")
DAY_BEFORE = ticker("2024-01-13 12:00:00", "2024-01-14 12:00:00")
FIRST_DAY = ticker("2023-12-31 23:59:59", "2024-01-01 23:59:59")

VERSIONS = """loads AS (
  SELECT CAST(p_partkey AS VARCHAR) AS symbol, CAST(p_retailprice AS DECIMAL(12,2)) AS p,
         p_size, p_type, p_brand, 14 AS day FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(p_retailprice AS DECIMAL(12,2)) + 1,
         p_size, p_type, p_brand, 15 FROM part WHERE p_type IN ('ECONOMY', 'PROMO')),
v AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day) AS filter_type_id,
         '2024-01-' || day AS load_date, CASE day WHEN 14 THEN 'TRADING' ELSE 'BREAK' END AS status
  FROM loads)"""

SYMBOL_DIM = """users AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, min(ts) < TIMESTAMP '2024-01-02' AS early
  FROM events GROUP BY user_id),
dim AS (
  SELECT symbol, early, row_number() OVER (ORDER BY early DESC, symbol) AS symbol_id FROM users)"""

PARENT = "symbol, filter_type_id"

FILTERS = {
    "PRICE_FILTER": [
        f"SELECT {_r('p * 100', 'maxPrice')}, {_r('p', 'minPrice')}, {_r('0.01', 'tickSize')}, {PARENT} FROM v"
    ],
    "LOT_SIZE": [
        f"SELECT {_r('0.001', 'stepSize')}, {_r('p_size * 1000', 'maxQty')}, {_r('0.001', 'minQty')}, {PARENT} FROM v",
        f"SELECT {_r('1', 'stepSize')}, {_r('p_size', 'maxQty')}, {_r('1', 'minQty')}, {PARENT} FROM v WHERE p_type = 'PROMO'",
    ],
    "ICEBERG_PARTS": [f"""SELECT p_size AS "limit", {PARENT} FROM v WHERE p_type <> 'SMALL'"""],
    "MARKET_LOT_SIZE": [
        f"SELECT {_r('0', 'stepSize')}, {_r('p_size * 100', 'maxQty')}, {_r('0', 'minQty')}, {PARENT} FROM v"
    ],
    "TRAILING_DELTA": [
        f"SELECT {_r('10', 'minTrailingBelowDelta')}, {_r('p_size + 2000', 'maxTrailingBelowDelta')}, "
        f"{_r('p_size + 3000', 'maxTrailingAboveDelta')}, {_r('10', 'minTrailingAboveDelta')}, {PARENT} FROM v"
    ],
    "PERCENT_PRICE_BY_SIDE": [
        f"SELECT {_r('5', 'bidMultiplierUp')}, {_r('5.5', 'askMultiplierUp')}, {_r('0.2', 'bidMultiplierDown')}, "
        f"{_r('p_size', 'avgPriceMins')}, {_r('0.25', 'askMultiplierDown')}, {PARENT} FROM v"
    ],
    "NOTIONAL": [
        f"""SELECT {_r('p * 1000', 'maxNotional')}, {_r('p', 'minNotional')}, {_r('p_size', 'avgPriceMins')},
        p_size > 25 AS "applyMinToMarket",
        CASE WHEN p_type = 'SMALL' THEN NULL ELSE false END AS "applyMaxToMarket", {PARENT} FROM v"""
    ],
    "MAX_NUM_ORDERS": [f'SELECT p_size + 200 AS "maxNumOrders", {PARENT} FROM v'],
    "MAX_NUM_ALGO_ORDERS": [f'SELECT CAST(5 AS INTEGER) AS "maxNumAlgoOrders", {PARENT} FROM v'],
}

FILTER_SIZES = {
    "PRICE_FILTER": ("4", ""),
    "LOT_SIZE": ("4", ""),
    "MARKET_LOT_SIZE": ("4", ""),
    "TRAILING_DELTA": ("5", ""),
    "PERCENT_PRICE_BY_SIDE": ("6", ""),
    "NOTIONAL": ("CASE WHEN p_type = 'SMALL' THEN 5 ELSE 6 END", ""),
    "MAX_NUM_ORDERS": ("2", ""),
    "MAX_NUM_ALGO_ORDERS": ("2", ""),
    "UNKNOWN_RULE": ("2", ""),
    "ICEBERG_PARTS": ("2", "WHERE p_type <> 'SMALL'"),
}


def _exploded() -> str:
    parts = [
        f"SELECT symbol, filter_type_id, '{kind}' AS \"filterType\", "
        f"CAST({size} AS INTEGER) AS n_keys FROM v {where}"
        for kind, (size, where) in FILTER_SIZES.items()
    ]
    parts.append(
        "SELECT symbol, filter_type_id, 'LOT_SIZE', CAST(4 AS INTEGER) FROM v WHERE p_type = 'PROMO'"
    )
    return f"WITH {VERSIONS} " + " UNION ALL ".join(parts)


TYPED_TRADE = f"""trade_id, maker AS "isBuyerMaker", true AS "isBestMatch", {_r('price', 'price')},
  {_r('qty', 'qty')}, {_r('quote', 'quoteQty')}, trade_time, symbol,
  CAST(CAST(trade_time AS DATE) AS VARCHAR) AS trade_date"""

SYMBOL_NUMBERS = ", ".join(
    f'p_size AS "{name}"'
    for name in (
        "baseAssetPrecision",
        "quotePrecision",
        "quoteAssetPrecision",
        "baseCommissionPrecision",
        "quoteCommissionPrecision",
    )
)
SYMBOL_FLAGS = ", ".join(
    f'true AS "{name}"'
    for name in (
        "ocoAllowed",
        "quoteOrderQtyMarketAllowed",
        "allowTrailingStop",
        "cancelReplaceAllowed",
        "isSpotTradingAllowed",
    )
)


#: Versions of the job for metadata: a changed load of the first day comes after that of the second.
JOB_VERSIONS = VERSIONS.replace(
    "),\nv AS (", """
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), CAST(p_retailprice AS DECIMAL(12,2)),
         p_size, p_type, p_brand, 16 FROM part WHERE p_size % 2 = 0),\nv AS ("""
).replace("'2024-01-' || day AS load_date", "CASE day WHEN 15 THEN '2024-01-15' ELSE '2024-01-14' END AS load_date"
).replace("CASE day WHEN 14 THEN 'TRADING' ELSE 'BREAK' END", "CASE day WHEN 14 THEN 'TRADING' WHEN 15 THEN 'BREAK' ELSE 'HALT' END")


#: Trades that the last derived candles know of.
DERIVED = "(SELECT * FROM events WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-15 12:00:30') e"


def _filter_values() -> str:
    """One row per value of the nine filter types."""
    parts = []
    for kind, target in FILTER_TYPES.items():
        name = target.table.removesuffix("_detail")
        columns = list(target.columns)
        for select in FILTERS[kind]:
            values = ", ".join(f"""{{'name': '{c}', 'value': CAST("{c}" AS DOUBLE)}}""" for c in columns)
            source = select.replace(f"{PARENT} FROM", f"{PARENT}, load_date FROM")
            parts.append(
                f"SELECT kind, symbol, filter_type_id, load_date, v.name AS name, v.value AS value FROM ("
                f"SELECT '{name}' AS kind, symbol, filter_type_id, load_date, unnest([{values}]) AS v FROM ({source}))"
            )
    return f"WITH {JOB_VERSIONS} " + " UNION ALL ".join(parts)


def _oracle() -> dict[str, str]:
    t, users = trades(), trades("user_id")
    klines = f"WITH {t}, {KLINES} SELECT {KLINE_COLUMNS} FROM k"
    out = {
        "lake_daily_slice": f"""WITH {t} SELECT trade_id AS id,
            CAST(CAST(price AS DECIMAL(20,10)) AS VARCHAR) AS price, CAST(qty AS VARCHAR) AS qty,
            CAST(CAST(quote AS DECIMAL(38,10)) AS VARCHAR) AS "quoteQty",
            epoch_us(ts) // 1000 AS "time", maker AS "isBuyerMaker", symbol,
            CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(15 AS INTEGER) AS day
            FROM t WHERE symbol = 'click' AND CAST(ts AS DATE) = DATE '2024-01-15'""",
        "lake_empty_slice": f"""WITH {t} SELECT symbol, trade_id AS id, epoch_us(ts) // 1000 AS "time"
            FROM t WHERE symbol = 'click' AND CAST(ts AS DATE) = DATE '2023-12-31'""",
        "lake_row_counts": f"""WITH {t} SELECT symbol, count(*) AS n_rows FROM t
            WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY symbol""",
        "lake_round_trip": """SELECT event_type AS symbol, CAST(year(ts) AS INTEGER) AS year,
            CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
            count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum
            FROM events GROUP BY ALL""",
        "raw_json_parse": f"WITH {t} SELECT {TYPED_TRADE.replace('true AS \"isBestMatch\", ', '')} FROM t",
        "raw_json_klines": klines,
        "raw_json_filters": """SELECT CAST(p_partkey AS VARCHAR) AS symbol,
            'ICEBERG_PARTS' AS filter_type, CAST(p_size AS VARCHAR) AS value_text,
            CAST(NULL AS VARCHAR) AS flag_text FROM part
            UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'NOTIONAL',
            CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), 'true' FROM part""",
        "decimal_rejects": f"""WITH {t} SELECT symbol, count(*) AS n_rows,
            count(*) FILTER (price * 100000000 >= 10000000000) AS price_rejects,
            count(*) FILTER (qty >= 10000000000) AS qty_rejects FROM t GROUP BY symbol""",
        "landing_rejects": f"""WITH {t}, fate AS (
            SELECT symbol, trade_id // 20 AS page, CASE
              WHEN trade_id < 10000 THEN CASE WHEN (trade_id // 20) % 7 = 3 THEN 'cut page' ELSE 'kept' END
              WHEN trade_id % 97 = 0 OR trade_id % 89 = 0 THEN 'broken'
              WHEN trade_id % 83 = 0 THEN 'no key' ELSE 'kept' END AS kind, trade_id >= 10000 AS single
            FROM t)
            SELECT symbol, kind, count(*) AS n FROM (
              SELECT symbol, kind FROM fate WHERE kind <> 'cut page'
              UNION ALL SELECT DISTINCT ON (symbol, page) symbol, 'broken' FROM fate WHERE kind = 'cut page')
            GROUP BY symbol, kind
            UNION ALL SELECT symbol, 'lines', count(*) FILTER (single) + count(DISTINCT page) FILTER (NOT single)
            FROM fate GROUP BY symbol
            UNION ALL SELECT unnest(['SymbolInfor', 'Klines', 'Ticker_24h']), 'empty', 0""",
        "trade_gap_plan": """WITH ids AS (
              SELECT event_id AS id, event_id // 4096 AS s, event_id // 64 AS b FROM events),
            stored AS (SELECT s, id FROM ids WHERE (b % 2 = 0 AND b % 7 <> 3) OR (b % 2 = 1 AND b % 5 <> 1)),
            wanted AS (SELECT s, min(id) + 1000 AS first_id, max(id) AS last_id FROM ids GROUP BY s),
            ends AS (SELECT s, id FROM stored UNION ALL SELECT s, last_id + 1 FROM wanted),
            holes AS (
              SELECT e.s, coalesce(lag(id) OVER (PARTITION BY e.s ORDER BY id) + 1, first_id) AS low,
                id - 1 AS high FROM ends e JOIN wanted w ON w.s = e.s),
            pages AS (SELECT s, high, unnest(generate_series(low, high, 50)) AS from_id FROM holes WHERE low <= high)
            SELECT CAST(s AS VARCHAR) AS symbol, from_id, least(from_id + 49, high) AS to_id FROM pages""",
        "job_derived_klines": f"""WITH {trades(source=DERIVED)}, {KLINES}
            SELECT symbol, opentime, {_r('o', 'openPrice')}, {_r('c', 'closePrice')}, {_r('v', 'volume')},
            n AS numberoftrades, row_number() OVER (PARTITION BY symbol ORDER BY opentime) AS kline_id FROM k""",
        "job_derived_ticker": f"""WITH {t}, one AS (WITH {ticker('2024-01-13 12:00:30', '2024-01-14 12:00:30')} SELECT * FROM w),
            two AS (WITH {ticker('2024-01-14 12:00:30', '2024-01-15 12:00:30')} SELECT * FROM w),
            stored AS (FROM one UNION ALL FROM two)
            SELECT symbol, close_time AS "closeTime", {_r('prev', 'prevClosePrice')}, {_r('c', 'lastPrice')},
            {_r(_half_up('qv', 'v'), 'weightedAvgPrice')}, first_id AS "firstTradeId", last_id AS "lastTradeId",
            n AS "count", row_number() OVER (PARTITION BY symbol ORDER BY close_time) AS ticker_id FROM stored""",
        "job_rejects": f"""WITH {t}, r AS (
              SELECT trade_time < {MIDNIGHT} AS early, trade_id, qty, price FROM t)
            SELECT load_date, column_name, n_rows, n_rejects FROM (
              SELECT CASE WHEN early THEN '2024-01-14' ELSE '2024-01-15' END AS load_date, count(*) AS n_rows,
                count(*) FILTER (NOT early AND trade_id % 11 = 0) AS k,
                count(*) FILTER (NOT early AND price * 100000000 >= 10000000000) AS p,
                count(*) FILTER (NOT early AND trade_id % 5 = 0) AS q
              FROM r GROUP BY early), LATERAL (SELECT unnest([
                {{'column_name': '', 'n_rejects': k}}, {{'column_name': 'price', 'n_rejects': p}},
                {{'column_name': 'qty', 'n_rejects': q}}, {{'column_name': 'quoteQty', 'n_rejects': 0}}], recursive := true))""",
        "job_symbols": f"""WITH {JOB_VERSIONS} SELECT symbol, load_date, filter_type_id AS filterstype_id, status,
            p_brand AS "baseAsset", p_size AS "baseAssetPrecision", p_size > 25 AS "icebergAllowed" FROM v""",
        "job_filters": _filter_values(),
        "filter_join": f"""WITH {JOB_VERSIONS} SELECT symbol, filter_type_id, {_r('p', 'minPrice')}, {_r('0.01', 'tickSize')},
            {_r('q', 'minQty')}, {_r('q', 'stepSize')} FROM (
              SELECT *, 0.001 AS q FROM v UNION ALL SELECT *, 1 FROM v WHERE p_type = 'PROMO')""",
        "trades_clean": f"WITH {t} SELECT {TYPED_TRADE} FROM t",
        "klines_clean": klines,
        "ticker_clean": f"""WITH {users}, {DAY} SELECT {TICKER_VALUES}, {_r('c', 'bidPrice')},
            {_r('c', 'askPrice')}, first_id AS "firstTradeId", last_id AS "lastTradeId",
            n AS "count" FROM w""",
        "symbol_infor": f"""WITH {VERSIONS} SELECT symbol, status, p_brand AS "baseAsset",
            p_type AS "quoteAsset", {SYMBOL_NUMBERS}, filter_type_id AS filterstype_id,
            p_size > 25 AS "icebergAllowed", {SYMBOL_FLAGS}, false AS "isMarginTradingAllowed",
            'NONE' AS "defaultSelfTradePreventionMode", load_date FROM v""",
        "epoch_ms_to_ts": """SELECT event_id, epoch_us(ts) // 1000 AS ms,
            date_trunc('second', ts) AS trade_time,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS trade_time_text FROM events""",
        "date_parts": """SELECT event_id, strftime(ts, '%Y') AS year_text,
            strftime(ts, '%m') AS month_text, strftime(ts, '%d') AS day_text,
            strftime(ts, '%Y') AS year_split, strftime(ts, '%m') AS month_split,
            strftime(ts, '%d') AS day_split, CAST(year(ts) AS INTEGER) AS year_no,
            CAST(month(ts) AS INTEGER) AS month_no, CAST(day(ts) AS INTEGER) AS day_no
            FROM events""",
        "report_bounds": """SELECT o_orderkey, date_trunc('second', o_orderdate) AS current_time,
            date_trunc('second', o_orderdate) - INTERVAL 1 DAY AS previous_time
            FROM orders""".replace("AS current_time", 'AS "current_time"'),
        "filters_exploded": _exploded(),
        "filter_matrix": f"""WITH {VERSIONS} SELECT {PARENT},
            CAST(1 AS BIGINT) AS price_filter,
            CAST(CASE p_type WHEN 'PROMO' THEN 2 ELSE 1 END AS BIGINT) AS lot_size_filter,
            CAST(CASE p_type WHEN 'SMALL' THEN 0 ELSE 1 END AS BIGINT) AS iceberg_parts_filter,
            CAST(1 AS BIGINT) AS market_lot_size_filter,
            CAST(1 AS BIGINT) AS trailing_delta_filter,
            CAST(1 AS BIGINT) AS percent_price_by_side_filter,
            CAST(1 AS BIGINT) AS notional_filter,
            CAST(1 AS BIGINT) AS max_num_orders_filter,
            CAST(1 AS BIGINT) AS max_num_algo_orders_filter FROM v""",
        "filter_version": f"""WITH {VERSIONS} SELECT symbol, load_date,
            filter_type_id AS filterstype_id, status FROM v WHERE day = 15""",
        "current_symbols": f"""WITH {VERSIONS} SELECT symbol, filter_type_id AS filterstype_id,
            load_date, status FROM v
            QUALIFY filter_type_id = max(filter_type_id) OVER (PARTITION BY symbol)""",
        "symbol_dim": f"WITH {SYMBOL_DIM} SELECT symbol_id, symbol FROM dim",
        "first_symbols": f"""WITH {SYMBOL_DIM} SELECT symbol_id, symbol FROM dim
            ORDER BY symbol_id LIMIT 100""",
        "distinct_symbols": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events",
        "symbol_id_lookup": f"""WITH {SYMBOL_DIM} SELECT e.event_id AS trade_id, d.symbol,
            CASE WHEN d.early THEN d.symbol_id ELSE 0 END AS symbol_id
            FROM events e JOIN dim d ON CAST(e.user_id AS VARCHAR) = d.symbol""",
        "latest_trade_id": """SELECT CAST(user_id AS VARCHAR) AS symbol,
            max(event_id) AS latest_id FROM events GROUP BY user_id""",
        "latest_order_id": """SELECT CAST(o_custkey AS VARCHAR) AS symbol,
            max(o_orderkey) AS latest_id FROM orders GROUP BY o_custkey""",
        "top_trade": f"""WITH {t} SELECT trade_id, symbol, {_r('price', 'price')}, trade_time
            FROM t ORDER BY trade_id DESC LIMIT 1""",
        "kline_ids": f"""WITH {t}, {KLINES}, numbered AS (
            SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY opentime) AS kline_id FROM k)
            SELECT symbol, opentime, {_r('c', 'closePrice')}, kline_id FROM numbered
            WHERE opentime >= {MIDNIGHT}""",
        "incremental_trades": f"""WITH {users}, w AS (
            SELECT symbol, max(trade_id) AS latest FROM t WHERE trade_time < {MIDNIGHT}
            GROUP BY symbol)
            SELECT t.symbol, t.trade_id FROM t LEFT JOIN w ON t.symbol = w.symbol
            WHERE t.trade_id > coalesce(w.latest, -1)""",
        "append_new_trades": f"""WITH {t} SELECT symbol, trade_id, {_r('price', 'price')},
            CAST(CAST(trade_time AS DATE) AS VARCHAR) AS trade_date FROM t
            WHERE trade_time >= {MIDNIGHT}""",
        "append_new_klines": f"""WITH {t}, {KLINES} SELECT symbol, opentime,
            n AS numberoftrades FROM k WHERE opentime >= {MIDNIGHT}""",
        "replace_partial_klines": f"""WITH {t}, {KLINES} SELECT symbol, opentime,
            n AS numberoftrades,
            CAST(CASE WHEN opentime < {MIDNIGHT} THEN 7 ELSE 0 END AS BIGINT) AS kline_id
            FROM k WHERE opentime >= {MIDNIGHT} OR minute(opentime) % 2 = 0""",
        "page_concat": f"""WITH {t}, pages AS (
            SELECT symbol, trade_id FROM t WHERE trade_time <= TIMESTAMP '2024-01-15 12:00:00'
            UNION ALL SELECT symbol, trade_id FROM t WHERE trade_time >= {MIDNIGHT})
            SELECT symbol, count(*) AS n_rows, CAST(sum(trade_id) AS BIGINT) AS id_sum
            FROM pages GROUP BY symbol""",
        "ticker_increment": f"""WITH {users}, {DAY}, l AS (
            SELECT symbol, max(trade_id) AS latest FROM t WHERE trade_time < {MIDNIGHT}
            GROUP BY symbol), r AS (
            SELECT w.symbol, last_id, CASE WHEN coalesce(latest, 0) = 0 THEN first_id
                   ELSE latest + 1 END AS first_id FROM w LEFT JOIN l ON w.symbol = l.symbol)
            SELECT symbol, first_id AS "firstId", last_id AS "lastId",
            last_id - first_id AS "count",
            greatest(last_id - first_id + 1, 0) AS count_inclusive FROM r""",
        "valid_tickers": f"""WITH {users}, {FIRST_DAY} SELECT symbol, first_id AS "firstId",
            last_id AS "lastId" FROM w WHERE first_id > 0 AND last_id > 0""",
        "trade_fetch_plan": f"""WITH {t}, {DAY}, pages AS (
            SELECT symbol, last_id, unnest(generate_series(first_id, last_id, 50)) AS from_id
            FROM w WHERE first_id >= 0 AND last_id >= 0)
            SELECT symbol, from_id, least(from_id + 49, last_id) AS to_id FROM pages""",
        "kline_fetch_plan": f"""WITH {users}, {DAY}, pages AS (
            SELECT symbol, epoch_ms(close_time) AS close_ms, unnest(generate_series(
                epoch_ms(open_time), epoch_ms(close_time), 43200000)) AS from_ms FROM w)
            SELECT symbol, from_ms, least(from_ms + 43199999, close_ms) AS to_ms FROM pages""",
        "klines_from_trades": klines,
        "klines_from_orders": f"WITH {ORDER_TRADES}, {KLINES} SELECT {KLINE_COLUMNS} FROM k",
        "ticker_from_trades": f"WITH {users}, {DAY} SELECT {TICKER_COLUMNS} FROM w",
        "ticker_from_klines": f"WITH {t}, {DAY} SELECT {TICKER_COLUMNS} FROM w",
        "ticker_from_orders": f"""WITH {ORDER_TRADES},
            {ticker('1998-06-14 12:00:00', '1998-06-15 12:00:00')}
            SELECT {TICKER_COLUMNS} FROM w""",
        "daily_trade_counts": f"""WITH {t} SELECT symbol, count(*) AS "NumberOfTrades" FROM t
            WHERE trade_time {WINDOW} GROUP BY symbol""",
        "lineitem_trade_counts": f"""SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
            count(*) AS "NumberOfTrades",
            {_r('sum(CAST(l_quantity AS DECIMAL(12,2)))', 'volume')},
            {_r('min(l_extendedprice)', 'lowPrice')}, {_r('max(l_extendedprice)', 'highPrice')}
            FROM lineitem GROUP BY l_suppkey""",
        "total_trades": """SELECT count(*) AS "TotalTrades" FROM events
            WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-15 12:00:00'""",
        "running_total_trades": """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n
            FROM events GROUP BY 1) SELECT CAST(day AS VARCHAR) AS day, n AS "NumberOfTrades",
            CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS "TotalTrades" FROM d""",
        "lineitem_running_totals": """WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day,
            count(*) AS n FROM lineitem GROUP BY 1)
            SELECT CAST(day AS VARCHAR) AS day, n AS "NumberOfTrades",
            CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS "TotalTrades" FROM d""",
        "symbol_trades_series": f"""WITH {t} SELECT trade_id, {_r('price', 'price')},
            {_r('qty', 'qty')}, trade_time FROM t
            WHERE symbol = 'click' AND trade_time {WINDOW} ORDER BY trade_time, trade_id""",
        "symbol_klines_series": f"""WITH {t}, {KLINES} SELECT opentime, {_r('o', 'openPrice')},
            {_r('c', 'closePrice')}, {_r('h', 'highPrice')}, {_r('l', 'lowPrice')} FROM k
            WHERE symbol = 'click' AND opentime {WINDOW} ORDER BY opentime""",
        "stream_trades": f"""WITH {t} SELECT symbol, trade_id, {_r('price', 'price')},
            trade_time FROM t""",
        "stream_distinct_trades": f"""WITH {t} SELECT symbol, trade_id, {_r('price', 'price')},
            trade_time FROM t""",
        "stream_klines": klines,
        "stream_klines_compacted": klines,
        "job_trades": f"""WITH {t} SELECT symbol, trade_id, {_r('price', 'price')}, {_r('qty', 'qty')},
            trade_time, CAST(CAST(trade_time AS DATE) AS VARCHAR) AS trade_date FROM t""",
        "job_klines": f"""WITH {t}, {KLINES} SELECT symbol, opentime, {_r('c', 'closePrice')},
            n AS numberoftrades,
            row_number() OVER (PARTITION BY symbol ORDER BY opentime) AS kline_id FROM k""",
        "job_ticker": f"""WITH {t}, one AS (WITH {DAY_BEFORE} SELECT * FROM w),
            two AS (WITH {DAY} SELECT * FROM w), stored AS (FROM one UNION ALL FROM two)
            SELECT symbol, close_time AS "closeTime", {_r('c', 'lastPrice')},
            first_id AS "firstTradeId", last_id AS "lastTradeId", n AS "count",
            row_number() OVER (PARTITION BY symbol ORDER BY close_time) AS ticker_id FROM stored""",
        "job_reports": f"""WITH {t}, {KLINES}
            SELECT 'symbol' AS kind, symbol AS key, count(*) AS n FROM t
            WHERE trade_time {WINDOW} GROUP BY symbol
            UNION ALL SELECT 'day', CAST(CAST(trade_time AS DATE) AS VARCHAR), count(*) FROM t
            WHERE trade_time < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 2
            UNION ALL SELECT 'total', 'all', count(*) FROM t
            WHERE trade_time <= TIMESTAMP '2024-01-15 12:00:00'
            UNION ALL SELECT 'trades', 'click', count(*) FROM t
            WHERE symbol = 'click' AND trade_time {WINDOW}
            UNION ALL SELECT 'klines', 'click', count(*) FROM k
            WHERE symbol = 'click' AND opentime {WINDOW}""",
    }
    for key, kind in FILTER_KEYS.items():
        out[key] = f"WITH {VERSIONS} " + " UNION ALL ".join(FILTERS[kind])
    return out


def oracle_sql() -> dict[str, str]:
    return _oracle()
