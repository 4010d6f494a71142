"""Doc-promised analytics: ATR, session VWAP, sector heatmap, basis, spread, gaps, momentum."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as an
from ..operators import calendar as cal
from ..operators import index as ix
from ..operators.bars import latest_snapshot
from ..sources import jsonl
from . import query
from .calendar import sql_in_session
from .curated import FACTORS_SQL
from .raw import RECEIPTS_SQL, all_receipts


@query("atr_gap_range", """
WITH x AS (SELECT symbol, date, open, high, low, close, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev_close
           FROM curated_daily),
y AS (SELECT symbol, date, open - prev_close AS gap, high - low AS "range",
             greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range FROM x)
SELECT *, avg(true_range) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS atr
FROM y
""")
def q_atr_gap_range(lk):
    return an.atr_gap_range(lk.curated_daily)


def _flagged(lk, df):
    return cal.in_session(df, lk.calendar)


@query("vwap_by_session", f"""
SELECT symbol, local_date, session_no,
       CAST(SUM(CAST(price AS HUGEINT) * volume) AS DOUBLE) / NULLIF(SUM(volume), 0) AS vwap_price,
       CAST(SUM(volume) AS BIGINT) AS total_volume, count(*) AS tick_count
FROM ({sql_in_session(extra=', price, volume')}) WHERE in_session GROUP BY 1, 2, 3
""")
def q_vwap_by_session(lk):
    return an.vwap_by_session(_flagged(lk, lk.curated_ticks))


@query("sector_heatmap", f"""
SELECT f.date, t.sector_l1, round(avg(f.daily_return), 9) AS mean_return,
       CAST(sum(d.foreign_buy_vol - d.foreign_sell_vol) AS BIGINT) AS foreign_net_buy,
       count(*) FILTER (WHERE f.daily_return > 0) AS gainers, count(*) FILTER (WHERE f.daily_return < 0) AS losers
FROM ({FACTORS_SQL}) f JOIN curated_daily d ON f.symbol = d.symbol AND f.date = d.date
LEFT JOIN (SELECT * FROM tickers WHERE snapshot = (SELECT max(snapshot) FROM tickers)) t ON f.symbol = t.symbol
GROUP BY 1, 2
""")
def q_sector_heatmap(lk):
    """M3: per date and sector over the latest listed universe (mean rounded to 9 dp)."""
    d = lk.curated_daily
    h = an.sector_heatmap(d, latest_snapshot(lk.tickers))
    return h.withColumn("mean_return", F.round("mean_return", 9))


@query("futures_basis", """
SELECT t.symbol, t.ts_event, t.trade_id, t.price, i.value AS index_value, t.price / 100.0::DOUBLE - i.value AS basis
FROM (SELECT * FROM curated_ticks WHERE asset_class = 'future') t
ASOF LEFT JOIN (SELECT ts_event, value, CAST(ts_event AS DATE) AS d FROM curated_index WHERE index_code = 'CLICK') i
  ON CAST(t.ts_event AS DATE) = i.d AND t.ts_event >= i.ts_event
""")
def q_futures_basis(lk):
    """M4: every future trade against its underlying (here the CLICK index) at trade time."""
    fut = lk.curated_ticks.where(F.col("asset_class") == "future")
    return an.futures_basis(fut, lk.curated_index, "CLICK")


@query("spread_imbalance", """
SELECT coalesce(s.symbol, b.symbol) AS symbol, coalesce(s.date, b.date) AS date, s.avg_spread_bps,
       b.avg_imbalance
FROM (SELECT symbol, date, avg(spread_bps) AS avg_spread_bps FROM curated_l1 GROUP BY 1, 2) s
FULL JOIN (SELECT symbol, date, round(avg(CAST(bid_sz_1 - ask_sz_1 AS DOUBLE) / NULLIF(bid_sz_1 + ask_sz_1, 0)), 9)
                  AS avg_imbalance FROM curated_l2 GROUP BY 1, 2) b
  ON s.symbol = b.symbol AND s.date = b.date
""")
def q_spread_imbalance(lk):
    return an.spread_imbalance(lk.curated_l1, lk.curated_l2).withColumn(
        "avg_imbalance", F.round("avg_imbalance", 9))


@query("gap_filled", """
WITH g0 AS (SELECT CASE WHEN coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END, false)
                        THEN value END AS v FROM gap_lines),
g AS (SELECT json_extract_string(v, '$.stream') AS stream,
             CAST(TRY_STRPTIME(json_extract_string(v, '$.start'), '%Y-%m-%d') AS DATE) AS s,
             CAST(TRY_STRPTIME(json_extract_string(v, '$.end'), '%Y-%m-%d') AS DATE) AS e,
             json_extract_string(v, '$.reason') AS reason
      FROM g0 WHERE v IS NOT NULL),
gd AS (SELECT CAST(d AS DATE) AS date, min(reason) AS gap_reason FROM (
         SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(coalesce(e, s) AS TIMESTAMP), INTERVAL 1 DAY)) AS d, reason
         FROM g WHERE stream = 'ticks' AND s IS NOT NULL AND coalesce(e, s) >= s) GROUP BY 1),
c AS (SELECT date, count(*) AS ticks FROM curated_ticks GROUP BY 1)
SELECT coalesce(c.date, gd.date) AS date, c.ticks, gd.gap_reason FROM c FULL JOIN gd ON c.date = gd.date
""")
def q_gap_filled(lk):
    return an.gap_filled(lk.curated_ticks, jsonl.read_gaps(lk.gap_lines))


@query("skip_present", f"""
WITH span AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM curated_ticks GROUP BY symbol),
planned AS (
  SELECT s.stream, span.symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM span, (VALUES ('ticks'), ('quotes_l1')) s(stream))
SELECT p.stream, p.symbol, p.date FROM planned p
WHERE NOT EXISTS (SELECT 1 FROM ({RECEIPTS_SQL}) r WHERE r.stream = p.stream AND r.symbol = p.symbol AND r.date = p.date)
""")
def q_skip_present(lk):
    """M8: (stream, symbol, day) triples of each symbol's span of ticks that have no receipt yet."""
    return an.skip_present(an.plan_fetches(lk.curated_ticks, ["ticks", "quotes_l1"]), all_receipts(lk))


@query("momentum", """
SELECT symbol, date, momentum,
       CAST(ntile(5) OVER (PARTITION BY date ORDER BY momentum, symbol) AS INTEGER) AS quintile
FROM (SELECT symbol, date, (close - lag(close, 20) OVER w) / NULLIF(lag(close, 20) OVER w, 0) AS momentum
      FROM curated_daily WINDOW w AS (PARTITION BY symbol ORDER BY date))
WHERE momentum IS NOT NULL
""")
def q_momentum(lk):
    return an.momentum(lk.curated_daily)


@query("spread_decay", f"""
SELECT session_no, CAST(hour(ts_event + INTERVAL 7 HOUR) AS INTEGER) AS local_hour,
       round(avg(spread_bps), 9) AS avg_spread_bps, count(*) AS quotes
FROM ({sql_in_session('curated_l1', 'symbol, ts_event, asset_class', ', spread_bps')})
WHERE in_session GROUP BY 1, 2
""")
def q_spread_decay(lk):
    """Quoted spread through the trading session."""
    return an.spread_decay(_flagged(lk, lk.curated_l1)).withColumn(
        "avg_spread_bps", F.round("avg_spread_bps", 9))


@query("gap_filled_by_symbol", """
WITH g0 AS (SELECT CASE WHEN coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END, false) THEN value END AS v FROM gap_lines),
g AS (SELECT s, coalesce(e, s) AS e, reason FROM (
        SELECT CAST(TRY_STRPTIME(json_extract_string(v, '$.start'), '%Y-%m-%d') AS DATE) AS s,
               CAST(TRY_STRPTIME(json_extract_string(v, '$.end'), '%Y-%m-%d') AS DATE) AS e, json_extract_string(v, '$.reason') AS reason
        FROM g0 WHERE json_extract_string(v, '$.stream') = 'ticks') WHERE s IS NOT NULL AND coalesce(e, s) >= s),
days AS (SELECT DISTINCT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM g),
islands AS (SELECT min(d) AS gap_start, max(d) AS gap_end FROM (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island FROM days) GROUP BY island),
named AS (SELECT gap_start, gap_end, string_agg(DISTINCT coalesce(reason, ''), '; ' ORDER BY coalesce(reason, '')) AS reasons
          FROM islands JOIN g ON s BETWEEN gap_start AND gap_end GROUP BY ALL),
c AS (SELECT symbol, date, count(*) AS ticks FROM curated_ticks GROUP BY ALL),
span AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM c GROUP BY symbol),
due AS (SELECT symbol, d AS date, gap_start, gap_end, reasons FROM span JOIN days ON d BETWEEN lo AND hi JOIN named ON d BETWEEN gap_start AND gap_end)
SELECT coalesce(c.symbol, due.symbol) AS symbol, coalesce(c.date, due.date) AS date, ticks, gap_start, gap_end, reasons
FROM c FULL JOIN due ON c.symbol = due.symbol AND c.date = due.date
""")
def q_gap_filled_by_symbol(lk):
    """M6: recorded gaps, overlapping ones counted once, against each symbol's own span."""
    return an.gap_filled_by_symbol(lk.curated_ticks, jsonl.read_gaps(lk.gap_lines))


@query("index_recompute", """
WITH RECURSIVE b AS (
  SELECT * FROM (SELECT symbol, date, close, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM curated_daily WHERE close > 0)
  WHERE prev IS NOT NULL),
held AS (SELECT b.symbol, b.date, b.close, b.prev, arg_max(f.market_cap, {'d': f.as_of_date, 'c': f.market_cap}) AS weight
         FROM b JOIN curated_fundamentals f ON f.symbol = b.symbol AND f.as_of_date < b.date AND f.market_cap > 0 GROUP BY ALL),
listed AS (SELECT symbol, sector_l1 AS index_code FROM tickers WHERE snapshot = (SELECT max(snapshot) FROM tickers)),
moves AS (
  SELECT index_code, date, count(*) AS constituents,
         CAST(sum(CAST(weight AS HUGEINT) * close * 1000000 // prev) AS DOUBLE) / CAST(sum(CAST(weight AS HUGEINT) * 1000000) AS DOUBLE) AS ratio
  FROM held JOIN listed USING (symbol) GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY index_code ORDER BY date) AS n FROM moves),
chained(index_code, n, date, constituents, chain) AS (
  SELECT index_code, n, date, constituents, ratio FROM numbered WHERE n = 1
  UNION ALL SELECT m.index_code, m.n, m.date, m.constituents, c.chain * m.ratio
  FROM chained c JOIN numbered m ON m.index_code = c.index_code AND m.n = c.n + 1),
published AS (SELECT listed.index_code, d.date, CAST(max(d.close) AS DOUBLE) AS value
              FROM curated_daily d JOIN listed USING (symbol) GROUP BY ALL),
j AS (SELECT c.*, p.value FROM chained c LEFT JOIN published p USING (index_code, date)),
base AS (SELECT index_code, arg_min(value, date) AS value, arg_min(chain, date) AS chain FROM j WHERE value IS NOT NULL GROUP BY index_code),
leveled AS (SELECT j.index_code, date, constituents, j.chain * (base.value / base.chain) AS level, j.value AS published FROM j JOIN base USING (index_code))
SELECT index_code, date, constituents, round(ln(level), 6) AS ln_level, published, round(abs(published - level) / level, 6) AS rel_diff,
       abs(published - level) / level > 0.001 AS off
FROM leveled
""")
def q_index_recompute(lk):
    """M9: one index per sector, weighted by market cap, against the greatest close of the sector's day as the published
    value (the level as its logarithm, as the bars' prices are random; rounded to 6 places)."""
    listed = latest_snapshot(lk.tickers).select("symbol", F.col("sector_l1").alias("index_code"))
    published = lk.curated_daily.join(listed, "symbol").groupBy("index_code", "date").agg(F.max("close").cast("double").alias("value"))
    weights = lk.curated_fundamentals.select("symbol", "as_of_date", F.col("market_cap").alias("weight"))
    out = ix.index_recompute(lk.curated_daily, weights, published, listed)
    return out.select("index_code", "date", "constituents", F.round(F.log("level"), 6).alias("ln_level"), "published",
                      F.round("rel_diff", 6).alias("rel_diff"), "off")
