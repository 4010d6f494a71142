"""Market-stream queries: VWAP, top of book, book as-of, ladder, tape, index, SDK reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import bars, book
from . import query

TICK_COLS = ("ts_event, ts_received, symbol, asset_class, exchange, price, volume, match_type, side, "
             "trade_id, seq, date")


@query("session_vwap", """
WITH turnover AS (
  SELECT date, exchange, asset_class, symbol, list(CAST(price AS HUGEINT) * volume) AS paid, list(volume) AS traded,
         list(ts_event) AS times
  FROM curated_ticks GROUP BY ALL)
SELECT date, exchange, asset_class, symbol, CAST(list_sum(paid) AS DOUBLE) / NULLIF(list_sum(traded), 0) AS vwap_price,
       CAST(list_sum(traded) AS BIGINT) AS total_volume, CAST(len(times) AS BIGINT) AS tick_count,
       list_min(times) AS first_tick_ts, list_max(times) AS last_tick_ts
FROM turnover
""")
def q_session_vwap(lk):
    return bars.session_vwap(lk.curated_ticks)


@query("top_of_book", """
WITH newest AS (
  SELECT date, symbol, arg_max(q, {'t': q.ts_event, 'r': q.ts_received, 'b': q.bid_price, 'a': q.ask_price}) AS q
  FROM (SELECT date, symbol, q FROM curated_l1 AS q) GROUP BY date, symbol)
SELECT date, symbol, q.asset_class, q.exchange, q.ts_event AS last_ts, q.bid_price, q.bid_size, q.ask_price, q.ask_size,
       q.mid_price, q.spread_bps
FROM newest
""")
def q_top_of_book(lk):
    return book.top_of_book(lk.curated_l1)


def _arr(side, what):
    return "[" + ", ".join(f"b.{side}_{what}_{i}" for i in range(1, schemas.BOOK_LEVELS + 1)) + "]"


@query("l2_at", f"""
SELECT t.symbol, t.trade_id, t.ts,
       CASE WHEN b.ts_event IS NULL THEN []::BIGINT[] ELSE {_arr('bid', 'px')} END AS bid_px,
       CASE WHEN b.ts_event IS NULL THEN []::BIGINT[] ELSE {_arr('bid', 'sz')} END AS bid_sz,
       CASE WHEN b.ts_event IS NULL THEN []::BIGINT[] ELSE {_arr('ask', 'px')} END AS ask_px,
       CASE WHEN b.ts_event IS NULL THEN []::BIGINT[] ELSE {_arr('ask', 'sz')} END AS ask_sz
FROM (SELECT symbol, trade_id, ts_event AS ts, date FROM curated_ticks) t
ASOF LEFT JOIN curated_l2 b ON t.symbol = b.symbol AND t.date = b.date AND t.ts >= b.ts_event
""")
def q_l2_at(lk):
    """J5, batch form: the book in force at every curated trade."""
    probes = lk.curated_ticks.select("symbol", "trade_id", F.col("ts_event").alias("ts"))
    return book.l2_at(lk.curated_l2, probes, "ts")


def _ladder_sql():
    def pick(side, what):
        return "[" + ", ".join(f"{side}_{what}_{i}" for i in range(1, 11)) + "][l.level]"
    return f"""
SELECT symbol, date, CAST(l.level AS INTEGER) AS level, {pick('bid', 'sz')} AS bid_sz,
       {pick('bid', 'px')} AS bid_px, {pick('ask', 'px')} AS ask_px, {pick('ask', 'sz')} AS ask_sz
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY ts_event DESC) AS rn
                     FROM curated_l2) WHERE rn = 1) AS lb,
     (SELECT unnest(range(1, 11)) AS level) AS l
"""


@query("l2_ladder", _ladder_sql())
def q_l2_ladder(lk):
    """P20: closing book of every symbol-day as a 10-level ladder."""
    w = Window.partitionBy("symbol", "date").orderBy(F.col("ts_event").desc())
    last = lk.curated_l2.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return book.l2_ladder(last, ["symbol", "date"])


@query("tick_tape", f"""
SELECT {TICK_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date
    ORDER BY ts_event DESC, trade_id DESC) AS rn FROM curated_ticks) WHERE rn <= 50
""")
def q_tick_tape(lk):
    """T4: latest 50 ticks of every symbol-day (top-k is the feature)."""
    return book.tick_tape(lk.curated_ticks, 50).drop("rank")


@query("index_daily", """
SELECT CAST(ts_event AS DATE) AS date, index_code, arg_max(value, ts_event) AS value,
       arg_max(change, ts_event) AS change, arg_max(change_pct, ts_event) AS change_pct
FROM curated_index GROUP BY 1, 2
""")
def q_index_daily(lk):
    return bars.index_daily(lk.curated_index)


@query("index_intraday", """
SELECT * FROM curated_index
WHERE ts_event >= CAST((SELECT max(date) FROM curated_index) - 6 AS TIMESTAMP)
  AND ts_event < CAST((SELECT max(date) FROM curated_index) + 1 AS TIMESTAMP)
""")
def q_index_intraday(lk):
    """All codes over the last seven days of data (inclusive)."""
    idx = lk.curated_index
    end = bars.max_value(idx, "date")
    return bars.index_intraday(idx, None, str(end - dt.timedelta(days=6)), str(end))


@query("daily", """
SELECT date, symbol, asset_class, exchange, open, high, low, close, volume, value
FROM curated_daily
WHERE symbol IN (SELECT symbol FROM tickers WHERE snapshot = (SELECT max(snapshot) FROM tickers))
""")
def q_daily(lk):
    """Bars of the latest listed universe over the whole range."""
    d = lk.curated_daily
    lo, hi = d.agg(F.min("date"), F.max("date")).first()
    universe = bars.latest_snapshot(lk.tickers)
    return bars.daily(d, universe, str(lo), str(hi))


@query("ticks", f"""
SELECT {TICK_COLS} FROM curated_ticks WHERE date = (SELECT max(date) FROM curated_ticks)
""")
def q_ticks(lk):
    """One day's ticks (the latest), all symbols."""
    t = lk.curated_ticks
    return bars.ticks_on(t, str(bars.max_value(t, "date")))


@query("latest_tickers", """
SELECT * FROM tickers WHERE snapshot = (SELECT max(snapshot) FROM tickers)
""")
def q_latest_tickers(lk):
    return bars.latest_snapshot(lk.tickers)
