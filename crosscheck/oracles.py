"""The same results as ANSI SQL over the raw tables."""

from __future__ import annotations

_RATES = """
    SELECT o_orderpriority AS currency_code,
           CAST(o_orderdate AS DATE) AS exchange_date,
           CAST(o_totalprice AS DECIMAL(10, 4)) AS rate_value
    FROM orders
"""

_STORED = f"""
    SELECT * FROM ({_RATES}) AS r
    WHERE exchange_date <= CASE currency_code
        WHEN '1-URGENT' THEN DATE '1998-01-01'
        WHEN '2-HIGH' THEN DATE '1999-01-01'
        WHEN '3-MEDIUM' THEN DATE '2000-01-01'
        WHEN '4-NOT SPECIFIED' THEN DATE '2001-01-01'
    END
"""

# Rates on the day of the order and again on the next day.
_TWO_DAYS = f"""
    SELECT currency_code, exchange_date, rate_value FROM ({_RATES}) AS r
    UNION ALL
    SELECT currency_code, CAST(exchange_date + INTERVAL 1 DAY AS DATE), rate_value
    FROM ({_RATES}) AS r
"""

_BARS = """
    SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
           CAST(l_shipdate AS DATE) AS trade_date,
           CAST(l_extendedprice AS DECIMAL(12, 2)) AS close_price,
           CAST(l_quantity AS BIGINT) AS volume
    FROM lineitem
"""


def _ohlc(decimal: str) -> str:
    return f"""
        CAST(l_suppkey AS VARCHAR) AS ticker,
        CAST(l_shipdate AS DATE) AS trade_date,
        CAST(l_discount AS {decimal}) AS open_price,
        CAST(l_extendedprice AS {decimal}) AS high_price,
        CAST(l_tax AS {decimal}) AS low_price,
        CAST(l_extendedprice AS {decimal}) AS close_price,
        CAST(l_quantity AS BIGINT) AS volume
    """


_LATEST = """
    SELECT 'orders' AS dataset, CAST(max(o_orderdate) AS DATE) AS latest_date FROM orders
    UNION ALL
    SELECT 'lineitem', CAST(max(l_shipdate) AS DATE) FROM lineitem
    UNION ALL
    SELECT 'events', CAST(max(ts) AS DATE) FROM events
"""

def _one_per_key(source: str, keys: str, order: str, columns: str) -> str:
    return f"""
        SELECT {columns}
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS place
              FROM ({source}) AS s) AS ranked
        WHERE place = 1
    """


_RATE_COLUMNS = "currency_code, exchange_date, rate_value"
_RATE_KEY = "currency_code, exchange_date"


ORACLES: dict[str, str] = {
    "rates_flatten": _TWO_DAYS,
    "rates_float": """
        SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS date,
               CAST(o_totalprice AS REAL) AS rate
        FROM orders
    """,
    "gold_normalise": """
        SELECT 'XAU' AS currency_code, CAST(o_orderdate AS DATE) AS exchange_date,
               CAST(o_totalprice AS DECIMAL(10, 2)) AS rate_value
        FROM orders
    """,
    "spread_calc": """
        SELECT *, CAST(ask_price - bid_price AS DECIMAL(11, 4)) AS spread_value
        FROM (SELECT CAST(l_suppkey AS VARCHAR) AS currency_code,
                     CAST(l_shipdate AS DATE) AS exchange_date,
                     CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(10, 4)) AS bid_price,
                     CAST(l_extendedprice AS DECIMAL(10, 4)) AS ask_price
              FROM lineitem) AS quotes
    """,
    "clean_bars": f"""
        SELECT {_ohlc("DECIMAL(12, 2)")} FROM lineitem
        WHERE l_discount <> 0.1 AND l_tax <> 0.08 AND l_quantity <> 1 AND l_extendedprice > 0
    """,
    "bars_hiprec": f'SELECT {_ohlc("DECIMAL(14, 4)")} FROM lineitem',
    "bars_rename": """
        SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
               l_discount AS open_price, l_extendedprice AS high_price, l_tax AS low_price,
               l_extendedprice AS close_price, l_quantity AS volume
        FROM lineitem
    """,
    "bars_with_group": f"""
        SELECT b.*, n.n_name AS group_name
        FROM ({_BARS}) AS b
        LEFT JOIN supplier AS s ON CAST(s.s_suppkey AS VARCHAR) = b.ticker
        LEFT JOIN nation AS n ON n.n_nationkey = s.s_nationkey
    """,
    "instrument_dim": """
        SELECT n_name AS group_name, CAST(s_suppkey AS VARCHAR) AS ticker
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL
        SELECT n_name, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
    """,
    "date_text_roundtrip": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text,
               CAST(o_orderdate AS DATE) AS date_value
        FROM orders
    """,
    "safe_name": """
        SELECT '^' || c_mktsegment || '-' || c_custkey || '=F' AS symbol,
               'IDX_' || c_mktsegment || '_' || c_custkey || 'FUT_F' AS name
        FROM customer
    """,
    "wide_to_long": """
        SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
               max(CAST(l_extendedprice AS DECIMAL(12, 2))) AS close_price,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2
    """,
    "drop_all_null": """
        SELECT * FROM (
            SELECT event_id, CASE WHEN value >= 10 THEN value END AS value,
                   CASE WHEN event_type NOT IN ('view', 'click') THEN props END AS props
            FROM events) AS sparse
        WHERE value IS NOT NULL OR props IS NOT NULL
    """,
    "valid_prices": """
        SELECT c_name AS ticker, DATE '2025-01-02' AS trade_date,
               CAST(c_acctbal AS DECIMAL(12, 2)) AS close_price
        FROM customer WHERE CAST(c_acctbal AS DECIMAL(12, 2)) > 0
    """,
    "json_field": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
    """,
    "rows_on_date": f"SELECT * FROM ({_RATES}) AS r WHERE exchange_date = DATE '1998-10-03'",
    "date_range": f"""
        SELECT * FROM ({_BARS}) AS b
        WHERE trade_date >= DATE '1996-01-01' AND trade_date < DATE '1999-01-01'
    """,
    "symbol_subset": f"""
        SELECT * FROM ({_RATES}) AS r WHERE currency_code IN ('1-URGENT', '5-LOW')
    """,
    "closed_sessions": """
        SELECT event_id, event_type, CAST(ts AS DATE) AS day, value
        FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20'
    """,
    "watermark_table": f"""
        SELECT coalesce(max(exchange_date), DATE '2020-01-01') AS watermark
        FROM ({_RATES}) AS r
    """,
    "watermark_per_key": f"""
        SELECT ticker, max(trade_date) AS watermark FROM ({_BARS}) AS b GROUP BY ticker
    """,
    "watermark_proxy_key": f"""
        SELECT coalesce(max(trade_date), DATE '2025-01-01') AS watermark
        FROM ({_BARS}) AS b WHERE ticker = '7'
    """,
    "watermark_min": f"SELECT min(latest_date) AS watermark FROM ({_LATEST}) AS l",
    "append_new_table": f"""
        SELECT * FROM ({_RATES}) AS r
        WHERE exchange_date > (SELECT max(exchange_date) FROM ({_STORED}) AS s)
    """,
    "append_new_per_key": f"""
        SELECT r.* FROM ({_RATES}) AS r
        LEFT JOIN (SELECT currency_code, max(exchange_date) AS watermark
                   FROM ({_STORED}) AS s GROUP BY currency_code) AS m
            ON m.currency_code = r.currency_code
        WHERE r.exchange_date > coalesce(m.watermark, DATE '1995-06-01')
    """,
    "append_idempotent": f"""
        WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY ticker, trade_date
                                         ORDER BY close_price DESC, volume DESC) AS place
            FROM ({_BARS}) AS b WHERE trade_date < DATE '1999-01-01'),
        stored AS (
            SELECT ticker, trade_date, close_price, volume FROM ranked WHERE place = 1),
        later AS (
            SELECT CAST(l_suppkey AS VARCHAR) AS ticker,
                   CAST(l_shipdate AS DATE) AS trade_date,
                   CAST(l_extendedprice AS DECIMAL(12, 2)) AS close_price,
                   CAST(l_linenumber AS BIGINT) AS volume
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
        batch AS (
            SELECT *, row_number() OVER (PARTITION BY ticker, trade_date
                                         ORDER BY close_price DESC, volume DESC) AS place
            FROM later)
        SELECT * FROM stored
        UNION ALL
        SELECT ticker, trade_date, close_price, volume FROM batch
        WHERE place = 1 AND NOT EXISTS (
            SELECT 1 FROM stored
            WHERE stored.ticker = batch.ticker AND stored.trade_date = batch.trade_date)
    """,
    "rates_distinct": f"SELECT DISTINCT * FROM ({_RATES}) AS r",
    "dedup_key": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               CAST(l_shipdate AS DATE) AS ship_date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC,
                           l_quantity DESC, l_suppkey DESC) AS place
              FROM lineitem) AS ranked
        WHERE place = 1
    """,
    "rows_per_key": """
        SELECT o_orderpriority AS currency_code, count(*) AS n_rows FROM orders GROUP BY 1
    """,
    "topk_keys": f"""
        SELECT ticker, count(*) AS n_rows FROM ({_BARS}) AS b
        GROUP BY ticker ORDER BY n_rows DESC, ticker LIMIT 10
    """,
    "preview_rows": """
        SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 5
    """,
    "last_n_per_key": """
        SELECT currency_code, exchange_date, o_orderkey, o_totalprice
        FROM (SELECT o_orderpriority AS currency_code,
                     CAST(o_orderdate AS DATE) AS exchange_date, o_orderkey, o_totalprice,
                     row_number() OVER (
                         PARTITION BY o_orderpriority
                         ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC,
                                  o_totalprice DESC) AS place
              FROM orders) AS ranked
        WHERE place <= 30
    """,
    "last_many_per_key": """
        SELECT l_returnflag, CAST(l_shipdate AS DATE) AS ship_date, l_orderkey, l_linenumber
        FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
                  ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC, l_linenumber DESC) AS place
              FROM lineitem) AS ranked
        WHERE place <= 5000
    """,
    "multi_source_union": _RATES,
    "history_rebuild": f"SELECT DISTINCT * FROM ({_TWO_DAYS}) AS r",
    "fetch_plan": f"""
        WITH placed AS (
            SELECT CAST(s_suppkey AS VARCHAR) AS ticker,
                   row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) - 1 AS place
            FROM supplier),
        marks AS (
            SELECT ticker, max(trade_date) AS watermark FROM ({_BARS}) AS b GROUP BY ticker)
        SELECT place // 30 AS chunk_id, count(*) AS n_keys,
               string_agg(placed.ticker, ',' ORDER BY placed.ticker) AS keys,
               CAST(min(coalesce(watermark, DATE '2024-01-01')) + INTERVAL 1 DAY AS DATE)
                   AS start_date,
               DATE '2001-10-26' AS end_date
        FROM placed LEFT JOIN marks ON marks.ticker = placed.ticker
        GROUP BY place // 30
        HAVING min(coalesce(watermark, DATE '2024-01-01')) + INTERVAL 1 DAY
               < DATE '2001-10-26'
    """,
    "backfill_plan": f"""
        WITH wanted AS (
            SELECT DISTINCT o_orderpriority AS currency_code, CAST(y.year AS INTEGER) AS year
            FROM orders, (SELECT unnest(range(1995, 2003)) AS year) AS y)
        SELECT currency_code, year, make_date(year, 1, 1) AS start_date,
               make_date(year, 12, 31) AS end_date
        FROM wanted WHERE NOT EXISTS (
            SELECT 1 FROM ({_STORED}) AS s
            WHERE s.currency_code = wanted.currency_code
              AND year(s.exchange_date) = wanted.year)
    """,
    "freshness": f"""
        SELECT dataset, latest_date,
               CASE WHEN latest_date = DATE '2024-01-30' THEN 'AVAILABLE' ELSE 'NOT YET' END
                   AS status
        FROM ({_LATEST}) AS l
    """,
    "load_gate": f"""
        SELECT e.latest_date, m.watermark, e.latest_date > m.watermark AS needs_load
        FROM (SELECT CAST(max(ts) AS DATE) AS latest_date FROM events) AS e,
             (SELECT min(latest_date) AS watermark FROM ({_LATEST}) AS l) AS m
    """,
    "session_gate": f"""
        SELECT strftime(as_of, '%Y-%m-%d %H:%M') AS as_of, start_date,
               CASE WHEN start_date > CAST(as_of AS DATE) THEN 'UP_TO_DATE'
                    WHEN start_date = CAST(as_of AS DATE) AND hour(as_of) < 22 THEN 'WAIT'
                    ELSE 'RUN' END AS status
        FROM (SELECT CAST(max(trade_date) + INTERVAL 1 DAY AS DATE) AS start_date
              FROM ({_BARS}) AS b) AS m,
             (VALUES (TIMESTAMP '2001-11-03 23:00:00'), (TIMESTAMP '2001-11-05 15:00:00'),
                     (TIMESTAMP '2001-11-05 22:00:00'), (TIMESTAMP '2001-12-01 09:30:00'))
                 AS moments(as_of)
    """,
    "load_audit": """
        SELECT 'orders' AS dataset, count(*) AS n_rows,
               CAST(min(o_orderdate) AS DATE) AS min_date,
               CAST(max(o_orderdate) AS DATE) AS max_date,
               CASE WHEN count(*) > 0 THEN 'LOADED' ELSE 'EMPTY' END AS status
        FROM orders
        UNION ALL
        SELECT 'lineitem', count(*), CAST(min(l_shipdate) AS DATE),
               CAST(max(l_shipdate) AS DATE),
               CASE WHEN count(*) > 0 THEN 'LOADED' ELSE 'EMPTY' END
        FROM lineitem
        UNION ALL
        SELECT 'events', count(*), CAST(min(ts) AS DATE), CAST(max(ts) AS DATE),
               CASE WHEN count(*) > 0 THEN 'LOADED' ELSE 'EMPTY' END
        FROM events
    """,
    "landed_rates_rebuild": f"SELECT DISTINCT * FROM ({_TWO_DAYS}) AS r",
    "landed_rates_multiline": f"SELECT DISTINCT * FROM ({_TWO_DAYS}) AS r",
    "landed_spreads_append": _one_per_key(
        """
        SELECT *, CAST(ask_price - bid_price AS DECIMAL(11, 4)) AS spread_value
        FROM (SELECT CAST(l_suppkey AS VARCHAR) AS currency_code,
                     CAST(l_shipdate AS DATE) AS exchange_date,
                     CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(10, 4)) AS bid_price,
                     CAST(l_extendedprice AS DECIMAL(10, 4)) AS ask_price
              FROM lineitem) AS quotes
        """,
        _RATE_KEY,
        "ask_price DESC, bid_price DESC",
        "currency_code, exchange_date, bid_price, ask_price, spread_value",
    ),
    "landed_gold_append_twice": """
        SELECT 'XAU' AS currency_code, CAST(o_orderdate AS DATE) AS exchange_date,
               max(CAST(o_totalprice AS DECIMAL(10, 2))) AS rate_value
        FROM orders GROUP BY 2
    """,
    "landed_bars_rebuild": f"""
        SELECT {_ohlc("DECIMAL(12, 2)")} FROM lineitem
        WHERE l_discount <> 0.1 AND l_tax <> 0.08 AND l_quantity <> 1 AND l_extendedprice > 0
    """,
    "landed_bars_mixed_headers": f"""
        SELECT {_ohlc("DECIMAL(12, 2)")} FROM lineitem
        WHERE l_discount <> 0.1 AND l_tax <> 0.08 AND l_quantity <> 1 AND l_extendedprice > 0
    """,
    "landed_bars_line_breaks": f"""
        SELECT {_ohlc("DECIMAL(12, 2)")} FROM lineitem
        WHERE l_discount <> 0.1 AND l_tax <> 0.08 AND l_quantity <> 1 AND l_extendedprice > 0
    """,
    "landed_rates_batch": _one_per_key(
        f"""
        SELECT currency_code, exchange_date, rate_value
        FROM ({_RATES}) AS r WHERE year(exchange_date) = 2000
        UNION ALL
        SELECT currency_code, CAST(exchange_date + INTERVAL 1 DAY AS DATE), rate_value
        FROM ({_RATES}) AS r WHERE year(exchange_date) = 2000
        """,
        _RATE_KEY,
        "rate_value DESC",
        _RATE_COLUMNS,
    ),
    "landed_backfill_plan": """
        SELECT c.code AS currency_code, CAST(y.year AS INTEGER) AS year,
               make_date(y.year, 1, 1) AS start_date, make_date(y.year, 12, 31) AS end_date
        FROM (SELECT DISTINCT o_orderpriority AS code FROM orders) AS c,
             (SELECT unnest(range(1998, 2002)) AS year) AS y
        WHERE NOT EXISTS (
            SELECT 1 FROM orders
            WHERE o_orderpriority = c.code AND c.code < '3'
              AND year(o_orderdate) = y.year AND y.year IN (1999, 2001))
    """,
    "landed_bars_quoted_headers": f"""
        SELECT {_ohlc("DECIMAL(12, 2)")} FROM lineitem
        WHERE l_discount <> 0.1 AND l_tax <> 0.08 AND l_quantity <> 1 AND l_extendedprice > 0
    """,
    "load_gate_per_key": f"""
        SELECT e.latest_date, m.watermark, e.latest_date > m.watermark AS needs_load
        FROM (SELECT CAST(max(ts) AS DATE) AS latest_date FROM events) AS e,
             (SELECT min(w) AS watermark FROM (
                 SELECT max(exchange_date) AS w FROM ({_STORED}) AS s GROUP BY currency_code) AS k
             ) AS m
    """,
    "rates_fetch_plan": f"""
        SELECT k.code, CAST(coalesce(w, DATE '2020-01-01') + INTERVAL 1 DAY AS DATE) AS start_date,
               DATE '2001-11-01' AS end_date
        FROM (SELECT DISTINCT o_orderpriority AS code FROM orders) AS k
        LEFT JOIN (SELECT currency_code AS code, max(exchange_date) AS w
                   FROM ({_STORED}) AS s GROUP BY currency_code) AS m ON m.code = k.code
        WHERE coalesce(w, DATE '2020-01-01') + INTERVAL 1 DAY <= DATE '2001-11-01'
    """,
    "landed_rates_per_key": f"""
        WITH stored AS ({_one_per_key(_STORED, _RATE_KEY, "rate_value DESC", _RATE_COLUMNS)}),
        batch AS (
            SELECT d.* FROM ({_TWO_DAYS}) AS d
            LEFT JOIN (SELECT currency_code, max(exchange_date) AS watermark
                       FROM stored GROUP BY currency_code) AS m
                ON m.currency_code = d.currency_code
            WHERE d.exchange_date > coalesce(m.watermark, DATE '2020-01-01'))
        SELECT {_RATE_COLUMNS} FROM stored
        UNION ALL
        {_one_per_key("SELECT * FROM batch", _RATE_KEY, "rate_value DESC", _RATE_COLUMNS)}
    """,
    "landed_rates_stream": _one_per_key(
        _TWO_DAYS, _RATE_KEY, "rate_value DESC", _RATE_COLUMNS
    ),
    "landed_rates_stream_cut": _one_per_key(
        _TWO_DAYS, _RATE_KEY, "rate_value DESC", _RATE_COLUMNS
    ),
    "rejected_rows": f"""
        WITH batch AS (
            SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_orderpriority END AS currency_code,
                   CAST(o_orderdate AS DATE) AS exchange_date,
                   CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(10, 4)) END AS rate_value
            FROM orders),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY {_RATE_KEY} ORDER BY rate_value DESC NULLS LAST) AS place
            FROM batch),
        judged AS (
            SELECT p.*, CASE WHEN p.currency_code IS NULL THEN 'no key' WHEN s.held THEN 'held'
                             WHEN place > 1 THEN 'repeated' WHEN rate_value IS NULL THEN 'misfit'
                             ELSE 'stored' END AS reason
            FROM placed AS p
            LEFT JOIN (SELECT DISTINCT {_RATE_KEY}, true AS held FROM ({_STORED}) AS x) AS s
                ON s.currency_code = p.currency_code AND s.exchange_date = p.exchange_date)
        SELECT 'stored' AS reason, true AS stored, count(*) AS n_rows FROM judged
        WHERE reason IN ('stored', 'misfit')
        UNION ALL
        SELECT reason, reason = 'misfit', count(*) FROM judged WHERE reason <> 'stored' GROUP BY reason
    """,
}
