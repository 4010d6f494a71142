"""SQL twin of `bindings.py` for the DuckDB oracle.

`VIEWS` holds named CTE bodies in dependency order; `with_views(sql)` prepends
exactly the ones a query mentions (and what those mention).  These are plain
view definitions over the parquet tables, independent of the Spark code.
"""

from __future__ import annotations

import re

from . import schemas

VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


N_SUP = "(SELECT count(*) FROM supplier)"

view("daily_raw", """
SELECT CAST(l_shipdate AS DATE) AS date,
       'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       'equity' AS asset_class,
       CASE l_suppkey % 3 WHEN 0 THEN 'HOSE' WHEN 1 THEN 'HNX' ELSE 'UPCoM' END AS exchange,
       c - l_linenumber * 50 AS open, c + l_linenumber * 100 AS high, c - l_linenumber * 100 AS low,
       c AS close, CAST(l_quantity AS BIGINT) AS volume, c * CAST(l_quantity AS BIGINT) AS value,
       (l_partkey % 1000) * 10 AS foreign_buy_vol, (l_orderkey % 1000) * 10 AS foreign_sell_vol,
       l_orderkey * 10 + l_linenumber AS ingest_seq
FROM (SELECT *, CAST(round_even(l_extendedprice * 100.0::DOUBLE / l_quantity, 0) AS BIGINT) AS c FROM lineitem)
""")

view("corp_actions_raw", f"""
SELECT CAST(o_orderdate AS DATE) AS ex_date,
       'S' || CAST(o_orderkey % {N_SUP} AS VARCHAR) AS symbol,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'split' WHEN '2' THEN 'dividend_cash'
            WHEN '3' THEN 'dividend_stock' WHEN '4' THEN 'rights' ELSE 'merger' END AS action_type,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1.02::DOUBLE WHEN '3' THEN 0.01::DOUBLE WHEN '4' THEN 0.005::DOUBLE END AS ratio,
       CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN CAST(o_custkey % 500 AS DOUBLE) END AS amount,
       CAST(o_orderdate AS DATE) + 2 AS record_date,
       CASE WHEN substr(o_orderpriority, 1, 1) = '2' THEN CAST(o_orderdate AS DATE) + 30 END AS payment_date,
       o_orderkey AS ingest_seq
FROM orders
""")

view("events_base", """
SELECT event_id, ts AS ts_event, ts + to_seconds(event_id % 5) AS ts_received,
       'U' || CAST(user_id % 20 AS VARCHAR) AS symbol,
       CASE WHEN event_type = 'click' THEN 'future' ELSE 'equity' END AS asset_class,
       CASE WHEN event_type = 'click' THEN 'HNX-DERIV' ELSE 'HOSE' END AS exchange,
       CAST(round_even(value * 100.0::DOUBLE, 0) AS BIGINT) AS p, event_type, value, user_id, props
FROM events
""")

view("ticks_raw", """
SELECT *, CAST(ts_event AS DATE) AS date FROM (
  SELECT ts_event, ts_received, symbol, asset_class, exchange, p AS price,
         event_id % 100 + 1 AS volume,
         CASE event_id % 20 WHEN 0 THEN 'ATO' WHEN 1 THEN 'ATC' WHEN 2 THEN 'put-through' ELSE 'continuous' END AS match_type,
         CASE event_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'S' ELSE '?' END AS side,
         'T' || CAST(event_id AS VARCHAR) AS trade_id, event_id AS seq
  FROM events_base
  UNION ALL
  SELECT ts_event, ts_received + to_seconds(60), symbol, asset_class, exchange, p + 1,
         event_id % 100 + 1,
         CASE event_id % 20 WHEN 0 THEN 'ATO' WHEN 1 THEN 'ATC' WHEN 2 THEN 'put-through' ELSE 'continuous' END,
         CASE event_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'S' ELSE '?' END,
         'T' || CAST(event_id AS VARCHAR), event_id
  FROM events_base WHERE event_id % 10 = 0)
""")

view("quotes_l1_raw", """
SELECT *, CAST(ts_event AS DATE) AS date FROM (
  SELECT ts_event, ts_received, symbol, asset_class, exchange,
         CASE WHEN event_id % 11 = 0 THEN CAST(0 AS BIGINT) ELSE p END AS bid_price,
         event_id % 100 + 1 AS bid_size,
         CASE WHEN event_id % 7 = 0 THEN p - 2 ELSE p + event_id % 7 END AS ask_price,
         event_id % 50 + 1 AS ask_size, event_id AS ingest_seq
  FROM events_base
  UNION ALL
  SELECT ts_event, ts_received + to_seconds(60), symbol, asset_class, exchange,
         CASE WHEN event_id % 11 = 0 THEN CAST(0 AS BIGINT) ELSE p END,
         event_id % 100 + 2,
         CASE WHEN event_id % 7 = 0 THEN p - 2 ELSE p + event_id % 7 END,
         event_id % 50 + 1, event_id
  FROM events_base WHERE event_id % 10 = 0)
""")


def _l2_select() -> str:
    cols = []
    for i in range(1, schemas.BOOK_LEVELS + 1):
        has_bid = f"{i} <= ingest_seq % 10 + 1 AND bid_price <> 0"
        bump = " + CASE WHEN ingest_seq % 13 = 0 THEN 1 ELSE 0 END" if i == 1 else ""
        cols += [f"CASE WHEN {has_bid} THEN bid_price - {i - 1}{bump} END AS bid_px_{i}",
                 f"CASE WHEN {has_bid} THEN (ingest_seq + {i}) % 90 + 1 END AS bid_sz_{i}",
                 f"CASE WHEN {has_bid} THEN (ingest_seq + {i}) % 7 + 1 END AS bid_n_{i}"]
    for i in range(1, schemas.BOOK_LEVELS + 1):
        has_ask = f"{i} <= ingest_seq % 10 + 1"
        cols += [f"CASE WHEN {has_ask} THEN ask_price + {i - 1} END AS ask_px_{i}",
                 f"CASE WHEN {has_ask} THEN (ingest_seq + {2 * i}) % 90 + 1 END AS ask_sz_{i}",
                 f"CASE WHEN {has_ask} THEN (ingest_seq + {2 * i}) % 7 + 1 END AS ask_n_{i}"]
    return ("SELECT ts_event, ts_received, symbol, asset_class, exchange,\n  "
            + ",\n  ".join(cols)
            + ",\n  ingest_seq, date, CAST(hour(ts_event) AS INTEGER) AS hour\nFROM quotes_l1_raw")


view("quotes_l2_raw", _l2_select())

view("index_raw", """
SELECT ts_event, ts_received, upper(event_type) AS index_code, 'HOSE' AS exchange,
       value, value - 50.0::DOUBLE AS change, (value - 50.0::DOUBLE) * 2.0::DOUBLE AS change_pct,
       event_id * 10 AS total_volume, event_id * 1000 AS total_value,
       CAST(event_id % 300 AS INTEGER) AS advance_count,
       CAST((event_id * 7) % 300 AS INTEGER) AS decline_count,
       CAST((event_id * 3) % 50 AS INTEGER) AS unchanged_count,
       event_id AS ingest_seq, CAST(ts_event AS DATE) AS date
FROM events_base
""")

view("fundamentals_raw", f"""
SELECT CAST(o_orderdate AS DATE) AS as_of_date,
       'S' || CAST(o_custkey % {N_SUP} AS VARCHAR) AS symbol,
       CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
       o_totalprice / 10000.0::DOUBLE AS pe, o_totalprice / 100000.0::DOUBLE AS pb,
       o_totalprice / 100.0::DOUBLE AS eps, o_totalprice / 10.0::DOUBLE AS bvps,
       (o_custkey % 30) / 100.0::DOUBLE AS roe, (o_custkey % 15) / 100.0::DOUBLE AS roa,
       (o_orderkey % 200) / 100.0::DOUBLE AS debt_to_equity,
       fl * 1000 AS market_cap, fl * 100 AS revenue, fl * 10 AS net_income,
       fl * 5000 AS total_assets, fl * 2000 AS total_equity, o_orderkey AS ingest_seq
FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS fl FROM orders)
""")

_TICKER_COLS = """'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name,
       CASE s_suppkey % 3 WHEN 0 THEN 'HOSE' WHEN 1 THEN 'HNX' ELSE 'UPCoM' END AS exchange,
       'equity' AS asset_class, r_name AS sector_l1, n_name AS sector_l2,
       r_name || '/' || n_name AS industry,
       DATE '2000-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS listed_date,
       CAST(100 AS BIGINT) AS lot_size, CAST(10 AS BIGINT) AS tick_size,
       s_acctbal / 1000.0::DOUBLE AS foreign_room_pct"""

view("tickers", f"""
SELECT {_TICKER_COLS}, 'listed' AS status, DATE '2024-01-01' AS snapshot
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT {_TICKER_COLS}, CASE WHEN s_suppkey % 10 = 0 THEN 'delisted' ELSE 'listed' END, DATE '2024-02-01'
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

view("futures_contracts", """
SELECT 'VN30F' || strftime(m, '%y%m') AS symbol, 'VN30' AS underlying_index,
       last_day(m) AS expiry_date, CAST(100000 AS BIGINT) AS contract_size,
       CAST(1 AS BIGINT) AS tick_size, 17.0::DOUBLE AS margin_pct, s.snapshot
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
CROSS JOIN (VALUES (DATE '2024-01-01'), (DATE '2024-02-01')) AS s(snapshot)
""")

view("messages_raw", """
SELECT msg_id, channel,
       CASE WHEN msg_id % 17 = 0 THEN '{broken ' || CAST(msg_id AS VARCHAR) ELSE payload END AS payload, ts_received
FROM (SELECT msg_id, channel, ts_received,
        CASE WHEN channel = 'tick' AND msg_id % 29 = 0 THEN regexp_replace(quoted, '"V":([0-9]+)', '"V":\\1.0')
             ELSE quoted END AS payload
 FROM (SELECT msg_id, channel, ts_received,
         CASE WHEN channel = 'tick' AND msg_id % 23 = 0 THEN regexp_replace(payload, '"P":(-?[0-9]+)', '"P":"\\1"')
              ELSE payload END AS quoted
  FROM (
  SELECT event_id AS msg_id, ch AS channel, ts_received,
    CASE ch
    WHEN 'tick' THEN json_object('S', symbol, 'P', price, 'V', event_id % 100 + 1, 'T', ms,
         'MT', CASE WHEN event_id % 20 <> 3 THEN 'continuous' END,
         'TID', 'T' || CAST(event_id AS VARCHAR), 'SEQ', event_id,
         'EX', CASE WHEN event_id % 8 <> 5 THEN exchange END,
         'SD', CASE event_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'S' END)::VARCHAR
    WHEN 'l1' THEN json_object('S', symbol, 'T', ms, 'EX', exchange,
         'BP', CASE WHEN event_id % 11 <> 0 THEN price END, 'BV', event_id % 100 + 1,
         'AP', p + event_id % 7, 'AV', event_id % 50 + 1)::VARCHAR
    WHEN 'l2' THEN json_object('S', symbol, 'T', ms, 'EX', exchange,
         'B', list_slice([json_object('P', price - i, 'V', (event_id + i) % 90 + 1, 'N', (event_id + i) % 7 + 1)
                          FOR i IN range(10)], 1, (event_id % 4) * 3 + 1),
         'A', list_slice([json_object('P', p + 1 + i, 'V', (event_id + 2 * i) % 90 + 1, 'N', (event_id + 2 * i) % 7 + 1)
                          FOR i IN range(10)], 1, (event_id % 5) * 2 + 1))::VARCHAR
    ELSE json_object('IC', upper(event_type), 'T', ms, 'EX', 'HOSE', 'V', value, 'C', value - 50.0::DOUBLE,
         'CP', (value - 50.0::DOUBLE) * 2.0::DOUBLE, 'TVO', event_id * 10, 'TVA', event_id * 1000,
         'ADV', event_id % 300, 'DEC', (event_id * 7) % 300, 'UNC', (event_id * 3) % 50)::VARCHAR
    END AS payload
  FROM (SELECT *, epoch_us(ts_event) // 1000 AS ms,
               CASE WHEN event_id % 19 = 0 THEN CAST(-1 AS BIGINT) ELSE p END AS price,
               CASE event_id % 4 WHEN 0 THEN 'tick' WHEN 1 THEN 'l1' WHEN 2 THEN 'l2' ELSE 'index' END AS ch
        FROM events_base))))
""")

view("alerts_raw", """
SELECT event_id AS alert_id, ts,
       to_base64(encode(CASE WHEN event_id % 3 = 0 THEN 'plain alert ' || event_type
         ELSE json_object('severity', CASE WHEN event_id % 5 <> 1 THEN sev END, 'name', nm,
                          'body', 'event=' || CAST(event_id AS VARCHAR),
                          'scope', CASE WHEN event_id % 4 <> 2 THEN sc END, 'source', 'ops')::VARCHAR END)) AS data,
       MAP {'severity': sev, 'scope': sc} AS attributes
FROM (SELECT *, CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warning' WHEN 'view' THEN 'info'
                  WHEN 'purchase' THEN 'debug' ELSE 'critical' END AS sev,
             'A' || CAST(user_id % 5 AS VARCHAR) AS nm, 'U/' || CAST(user_id % 3 AS VARCHAR) AS sc
      FROM events)
""")


# ----------------------------------------------------------------- curated layer
_ONE = "1.0::DOUBLE"


def _first(src: str, keys: str, order: str, cols: str = "* EXCLUDE (_rn)") -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
            f"FROM {src}) WHERE _rn = 1")


DAILY_COLS = ("date, symbol, asset_class, exchange, open, high, low, close, volume, value, "
              "foreign_buy_vol, foreign_sell_vol")
view("daily_dedup", _first("daily_raw WHERE year(date) <> 1900", "date, symbol", "date, ingest_seq", DAILY_COLS))
view("actions_dedup", _first("corp_actions_raw", "symbol, ex_date, action_type", "ex_date, ingest_seq"))
view("curated_corp_actions", "SELECT ex_date, record_date, payment_date, symbol, action_type, ratio, amount FROM actions_dedup")
view("action_factors", f"""
SELECT a.symbol, a.ex_date, a.action_type, a.ratio, a.amount, p.close AS close_prev,
  CASE WHEN a.action_type = 'split' THEN CASE WHEN a.ratio > 0 THEN {_ONE} / a.ratio ELSE {_ONE} END
       WHEN a.action_type IN ('dividend_stock', 'rights') THEN
            CASE WHEN a.ratio > 0 THEN {_ONE} / ({_ONE} + a.ratio) ELSE {_ONE} END
       WHEN a.action_type = 'dividend_cash' THEN
            CASE WHEN a.amount IS NULL OR a.amount = 0 OR p.close IS NULL OR p.close <= 0 THEN {_ONE}
                 ELSE (CAST(p.close AS DOUBLE) - a.amount) / CAST(p.close AS DOUBLE) END
       ELSE {_ONE} END AS factor
FROM actions_dedup a ASOF LEFT JOIN (SELECT symbol, date, close FROM daily_dedup) p
  ON a.symbol = p.symbol AND a.ex_date > p.date
""")
view("curated_daily", f"""
SELECT d.*, CASE WHEN s.fs IS NULL THEN d.close ELSE CAST(trunc(
         list_reduce(list_transform(list_filter(s.fs, lambda x: x.ex_date > d.date), lambda x: x.factor),
                     lambda p, q: p * q, {_ONE}) * d.close) AS BIGINT) END AS adj_close
FROM daily_dedup d LEFT JOIN (
  SELECT symbol, list(struct_pack(ex_date := ex_date, action_type := action_type, factor := factor)
                      ORDER BY ex_date, action_type, factor) AS fs
  FROM action_factors GROUP BY symbol) s ON d.symbol = s.symbol
""")
TICK_COLS = ("ts_event, ts_received, symbol, asset_class, exchange, price, volume, match_type, side, "
             "trade_id, seq, date")
view("curated_ticks", _first("ticks_raw", "symbol, ts_event, trade_id", "ts_event, ts_received, seq, price", TICK_COLS))
view("curated_l1", """
SELECT ts_event, ts_received, symbol, asset_class, exchange, bid_price, bid_size, ask_price, ask_size,
       mid_price,
       CASE WHEN mid_price > 0 THEN CAST(round_even(10000.0::DOUBLE * (ask_price - bid_price) / mid_price, 0) AS INTEGER) END AS spread_bps,
       date
FROM (SELECT *, CASE WHEN bid_price > 0 AND ask_price > 0 THEN (bid_price + ask_price) // 2 END AS mid_price
      FROM (""" + _first("quotes_l1_raw", "symbol, ts_event", "ts_event, ts_received, ingest_seq, bid_size") + "))")
view("curated_l2", _first("quotes_l2_raw", "symbol, ts_event", "ts_event, ts_received, ingest_seq",
                          "ts_event, ts_received, symbol, asset_class, exchange, "
                          + ", ".join(schemas.l2_columns()) + ", date, hour"))
view("curated_index", _first("index_raw", "index_code, ts_event", "ts_event, ts_received, ingest_seq",
                             "ts_event, ts_received, index_code, exchange, value, change, change_pct, total_volume, "
                             "total_value, advance_count, decline_count, unchanged_count, date"))
view("curated_fundamentals", _first("fundamentals_raw", "symbol, period", "as_of_date, ingest_seq",
                                    "as_of_date, symbol, period, pe, pb, eps, bvps, roe, roa, debt_to_equity, "
                                    "market_cap, revenue, net_income, total_assets, total_equity"))

view("tick_bars", """
SELECT date, symbol, 'equity' AS asset_class, 'HOSE' AS exchange,
       arg_min(price, seq * 1000000 + price) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, seq * 1000000 + price) AS close, CAST(sum(volume) AS BIGINT) AS volume,
       CAST(sum(price * volume) AS BIGINT) AS value
FROM ticks_raw GROUP BY date, symbol
""")
view("equity_curve", "SELECT symbol AS strategy, date, CAST(adj_close AS DOUBLE) AS equity FROM curated_daily")
view("universe_lines", """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN '"s' || CAST(s_suppkey AS VARCHAR) || '"'
            ELSE json_object('symbol', 'S' || CAST(s_suppkey AS VARCHAR))::VARCHAR END AS value FROM supplier
UNION ALL SELECT json_object('symbol', 'S' || CAST(s_suppkey AS VARCHAR))::VARCHAR FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT '' FROM supplier WHERE s_suppkey % 9 = 0
""")

view("gap_lines", """
SELECT CASE WHEN event_id % 150 = 0 THEN '{not json' WHEN event_id % 350 = 0 THEN '   '
            WHEN event_id % 250 = 0 THEN '{"stream": "ticks", "start": "soon", "end": "2024-13-45"}'
       ELSE json_object('stream', CASE WHEN event_id % 100 = 0 THEN 'ticks' ELSE 'quotes_l1' END,
                        'start', strftime(CAST(ts AS DATE), '%Y-%m-%d'),
                        'end', CASE WHEN event_id % 200 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                                    ELSE strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') END,
                        'reason', 'source_unavailable', 'recorded_at', strftime(ts, '%Y-%m-%dT%H:%M:%S'))::VARCHAR
       END AS value
FROM events
""")
view("dead_letter_lines", """
SELECT json_object('data', props,
                   'attributes', json_object('topic', CASE WHEN event_type IN ('click', 'view') THEN 'ticks' ELSE 'quotes-l1' END,
                                             'symbol', 'U' || CAST(user_id % 20 AS VARCHAR)),
                   'publish_time', strftime(ts, '%Y-%m-%dT%H:%M:%S'))::VARCHAR AS value
FROM events
""")

view("vendor_daily", """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS time,
       l_extendedprice / l_quantity - l_linenumber * 0.5::DOUBLE AS open,
       l_extendedprice / l_quantity + l_linenumber AS high, l_extendedprice / l_quantity - l_linenumber AS low,
       l_extendedprice / l_quantity AS close, l_quantity AS volume
FROM lineitem
""")
view("vendor_fundamentals", f"""
SELECT 'S' || CAST(o_custkey % {N_SUP} AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS report_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       o_totalprice / 10000.0::DOUBLE AS pe, o_totalprice / 100000.0::DOUBLE AS pb, o_totalprice / 100.0::DOUBLE AS eps
FROM orders
""")
view("vendor_corp_actions", "SELECT ex_date AS exDate, symbol, action_type, ratio, amount, record_date FROM corp_actions_raw")
view("vendor_tickers", """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name,
       CASE WHEN s_suppkey % 6 = 0 THEN 'N/A'
            ELSE strftime(DATE '2000-01-01' + CAST(s_suppkey % 3650 AS INTEGER), '%Y-%m-%d') END AS listed_date,
       CAST(100 AS BIGINT) AS lot_size
FROM supplier
""")
view("vendor_futures", """
SELECT symbol, underlying_index, strftime(expiry_date, '%Y-%m-%d') AS expiry_date, contract_size
FROM futures_contracts WHERE snapshot = DATE '2024-02-01'
""")
view("pull_results", """
SELECT 'primary' AS source, 1 AS rank, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
       CASE WHEN s_suppkey % 4 = 0 THEN 'error' ELSE 'ok' END AS status FROM supplier
UNION ALL
SELECT 'secondary', 2, 'S' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 8 = 0 THEN 'error' ELSE 'ok' END FROM supplier
""")
view("billing", "SELECT CAST(ts AS DATE) AS date, value AS cost FROM events")


def _json_fields(fields: dict[str, str]) -> str:
    def read(f: str, t: str) -> str:
        text = f"json_extract_string(payload, '$.{f}')"
        if t in ("BIGINT", "INTEGER"):  # quoted or fractional whole numbers are cut
            return f"TRY_CAST(trunc(TRY_CAST({text} AS DECIMAL(38,6))) AS {t})"
        return f"TRY_CAST({text} AS {t})"
    return ", ".join(f"CASE WHEN ok THEN {read(f, t)} END AS \"{f}\"" for f, t in fields.items())


def decode_sql(channel: str, fields: dict[str, str], required: list[str]) -> str:
    """Messages of one channel with typed wire fields and a parse_error text."""
    miss = ", ".join(f"CASE WHEN \"{f}\" IS NULL THEN '{f}' END" for f in required)
    return f"""
SELECT *, CASE WHEN NOT ok THEN 'unparsable'
               WHEN concat_ws(',', {miss}) <> '' THEN 'missing:' || concat_ws(',', {miss}) END AS parse_error
FROM (SELECT *, {_json_fields(fields)} FROM (
  SELECT msg_id, channel, payload, ts_received,
         coalesce(CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' END, false) AS ok
  FROM messages_raw WHERE channel = '{channel}'))"""


L2_FIELDS = {}
for _side, _k in (("bid", "B"), ("ask", "A")):
    for _i in range(schemas.BOOK_LEVELS):
        for _w, _f in (("px", "P"), ("sz", "V"), ("n", "N")):
            L2_FIELDS[f"{_k}[{_i}].{_f}"] = "BIGINT"
WIRE = {
    "tick": ({"S": "VARCHAR", "P": "BIGINT", "V": "BIGINT", "T": "BIGINT", "MT": "VARCHAR", "TID": "VARCHAR",
              "SEQ": "BIGINT", "EX": "VARCHAR", "SD": "VARCHAR"}, ["S", "P", "V", "T", "TID", "SEQ"]),
    "l1": ({"S": "VARCHAR", "T": "BIGINT", "EX": "VARCHAR", "BP": "BIGINT", "BV": "BIGINT", "AP": "BIGINT",
            "AV": "BIGINT"}, ["S", "T"]),
    "l2": ({"S": "VARCHAR", "T": "BIGINT", "EX": "VARCHAR", **L2_FIELDS}, ["S", "T"]),
    "index": ({"IC": "VARCHAR", "T": "BIGINT", "EX": "VARCHAR", "V": "DOUBLE", "C": "DOUBLE", "CP": "DOUBLE",
               "TVO": "BIGINT", "TVA": "BIGINT", "ADV": "INTEGER", "DEC": "INTEGER", "UNC": "INTEGER"},
              ["IC", "T", "V", "C", "CP", "TVO", "TVA", "ADV", "DEC", "UNC"]),
}
for _ch, (_fields, _req) in WIRE.items():
    view(f"decoded_{_ch}", decode_sql(_ch, _fields, _req))

CLASSIFY = "CASE WHEN starts_with(S, 'VN30F') OR starts_with(S, 'GB') THEN 'future' ELSE 'equity' END"
view("parsed_ticks", f"""
SELECT msg_id, epoch_ms(T) AS ts_event, ts_received, S AS symbol, {CLASSIFY} AS asset_class,
       coalesce(EX, 'HOSE') AS exchange, P AS price, V AS volume, coalesce(MT, 'continuous') AS match_type,
       coalesce(SD, '?') AS side, TID AS trade_id, SEQ AS seq
FROM decoded_tick WHERE parse_error IS NULL
""")
view("validated_ticks", """
SELECT *, NULLIF(concat_ws(',',
  CASE WHEN ts_event IS NULL THEN 'ts_event:missing' END, CASE WHEN symbol IS NULL THEN 'symbol:missing' END,
  CASE WHEN trade_id IS NULL THEN 'trade_id:missing' END, CASE WHEN price IS NULL THEN 'price:missing' END,
  CASE WHEN volume IS NULL THEN 'volume:missing' END, CASE WHEN seq IS NULL THEN 'seq:missing' END,
  CASE WHEN price < 0 THEN 'price<0' END, CASE WHEN volume < 0 THEN 'volume<0' END, CASE WHEN seq < 0 THEN 'seq<0' END,
  CASE WHEN exchange NOT IN ('HOSE', 'HNX', 'UPCoM', 'HNX-DERIV') THEN 'exchange:invalid' END,
  CASE WHEN match_type NOT IN ('ATO', 'continuous', 'ATC', 'put-through') THEN 'match_type:invalid' END,
  CASE WHEN side NOT IN ('B', 'S', '?') THEN 'side:invalid' END,
  CASE WHEN asset_class NOT IN ('equity', 'future', 'index') THEN 'asset_class:invalid' END), '') AS reject_reason
FROM parsed_ticks
""")
def _reasons(required: list[str], at_least_0: list[str]) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '{n}:missing' END" for c, n in required]
    parts += [f"CASE WHEN {c} < 0 THEN '{n}<0' END" for c, n in at_least_0]
    parts.append("CASE WHEN exchange NOT IN ('HOSE', 'HNX', 'UPCoM', 'HNX-DERIV') THEN 'exchange:invalid' END")
    return "NULLIF(concat_ws(',', " + ", ".join(parts) + "), '') AS reject_reason"


_WIRE_HEAD = "msg_id, epoch_ms(T) AS ts_event, ts_received, S AS symbol, coalesce(EX, 'HOSE') AS exchange"
view("validated_l1", f"""
SELECT msg_id, symbol, ts_event, {_reasons([('ts_event', 'ts_event'), ('symbol', 'symbol')],
                                           [(c, c) for c in ('bid_price', 'bid_size', 'ask_price', 'ask_size')])}
FROM (SELECT {_WIRE_HEAD}, coalesce(BP, 0) AS bid_price, coalesce(BV, 0) AS bid_size, coalesce(AP, 0) AS ask_price,
             coalesce(AV, 0) AS ask_size FROM decoded_l1 WHERE parse_error IS NULL)
""")
_L2_NAMES = [(f'"{k}[{i}].{f}"', f"{side}_{w}_{i + 1}") for side, k in (("bid", "B"), ("ask", "A"))
             for i in range(schemas.BOOK_LEVELS) for w, f in (("px", "P"), ("sz", "V"), ("n", "N"))]
_L2_ORDER = {c: n for n, c in enumerate(schemas.l2_columns())}
view("validated_l2", f"""
SELECT msg_id, symbol, ts_event, {_reasons([('ts_event', 'ts_event'), ('symbol', 'symbol')],
                                           sorted(_L2_NAMES, key=lambda x: _L2_ORDER[x[1]]))}
FROM (SELECT *, {_WIRE_HEAD.replace('msg_id, ', '').replace('ts_received, ', '')} FROM decoded_l2 WHERE parse_error IS NULL)
""")
view("validated_index", f"""
SELECT msg_id, index_code AS symbol, ts_event, {_reasons(
    [('ts_event', 'ts_event'), ('index_code', 'index_code')],
    [(c, c) for c in ('value', 'total_volume', 'total_value', 'advance_count', 'decline_count', 'unchanged_count')])}
FROM (SELECT msg_id, epoch_ms(T) AS ts_event, IC AS index_code, coalesce(EX, 'HOSE') AS exchange, V AS value,
             TVO AS total_volume, TVA AS total_value, ADV AS advance_count, DEC AS decline_count, UNC AS unchanged_count
      FROM decoded_index WHERE parse_error IS NULL)
""")
view("accepted_ticks", "SELECT * EXCLUDE (reject_reason), CAST(ts_event AS DATE) AS date FROM validated_ticks WHERE reject_reason IS NULL")


_HOLIDAY = "CASE " + " ".join(f"WHEN month(date) = {m} AND day(date) = {d} THEN '{n.replace(chr(39), chr(39) * 2)}'"
                              for m, d, n in schemas.FIXED_HOLIDAYS) + (
    " WHEN month(date) IN (1, 2) AND isodow(date) = 1 AND day(date) BETWEEN 15 AND 21 THEN 'Exchange closure' END")
view("cal_all_days", """
SELECT CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem
      UNION SELECT CAST(year(ts + INTERVAL 7 HOUR) AS INTEGER) FROM events)
""")
view("cal_holidays", f"SELECT date, {_HOLIDAY} AS name FROM cal_all_days WHERE {_HOLIDAY} IS NOT NULL")
view("cal_days", f"SELECT date, CAST(year(date) AS INTEGER) AS year FROM cal_all_days "
                 f"WHERE isodow(date) <= 5 AND {_HOLIDAY} IS NULL")


def with_views(sql: str) -> str:
    """Prefix `sql` with the CTEs it references, dependencies first."""
    names = list(VIEWS)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and re.search(rf"\b{n}\b", text):
                needed.add(n)
                visit(VIEWS[n])

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in names if n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
