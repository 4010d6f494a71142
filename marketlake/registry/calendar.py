"""Calendar and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import calendar as cal
from ..operators import quality
from ..operators.adjust import action_factors
from ..operators.curate import curate_daily_bars
from ..operators.dedup import dedup_first
from . import query


# ------------------------------------------------------------- SQL pieces
def _us(hm: str) -> int:
    h, m = hm.split(":")
    return (int(h) * 3600 + int(m) * 60) * 1000000


SQL_SESSIONS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {i + 1}, {_us(s)}, {_us(e)})" for c, ivs in schemas.SESSIONS.items()
    for i, (s, e) in enumerate(ivs)) + ") AS s(cls, session_no, s0, s1)"

# Vietnam keeps a fixed UTC+7 offset, so the oracle shifts by seven hours.
def sql_in_session(src: str = "curated_ticks", cols: str = "symbol, ts_event, trade_id, asset_class",
                   extra: str = "") -> str:
    return f"""
WITH t AS (SELECT {cols}{extra}, ts_event + INTERVAL 7 HOUR AS lt FROM {src}),
t2 AS (SELECT *, CAST(lt AS DATE) AS local_date, epoch_us(lt) - epoch_us(date_trunc('day', lt)) AS us,
              CASE WHEN asset_class = 'future' THEN 'derivative' ELSE 'equity' END AS cls FROM t),
ses AS ({SQL_SESSIONS}),
cal AS (SELECT date FROM cal_days)
SELECT {', '.join('t2.' + c.strip() for c in (cols + extra).split(','))}, t2.local_date,
       CASE WHEN c.date IS NOT NULL AND s.session_no IS NOT NULL THEN CAST(s.session_no AS INTEGER) END AS session_no,
       (c.date IS NOT NULL AND s.session_no IS NOT NULL) AS in_session
FROM t2 LEFT JOIN ses s ON t2.cls = s.cls AND t2.us BETWEEN s.s0 AND s.s1
LEFT JOIN cal c ON t2.local_date = c.date
"""


SQL_IN_SESSION = sql_in_session()

# ---------------------------------------------------------------- queries
def _flag_ticks(lk):
    return cal.in_session(lk.curated_ticks, lk.calendar)


@query("read_calendar", "SELECT date, year FROM cal_days")
def q_read_calendar(lk):
    """A10: the year documents' trading days."""
    return lk.calendar.days


@query("trading_day_flags", """
SELECT d.date, t.date IS NOT NULL AS is_trading_day, h.name AS holiday_name, CAST(year(d.date) AS INTEGER) AS year
FROM (SELECT DISTINCT date FROM curated_daily) d
LEFT JOIN cal_days t ON d.date = t.date LEFT JOIN cal_holidays h ON d.date = h.date
""")
def q_trading_day_flags(lk):
    return cal.trading_day_flags(lk.curated_daily.select("date").distinct(), lk.calendar)


@query("in_session", SQL_IN_SESSION)
def q_in_session(lk):
    return _flag_ticks(lk).select("symbol", "ts_event", "trade_id", "asset_class", "local_date",
                                  "session_no", "in_session")


MISSING_SQL = """
WITH c AS (SELECT date, row_number() OVER (ORDER BY date) AS idx FROM cal_days),
b AS (SELECT d.symbol, c.idx FROM curated_daily d JOIN c ON d.date = c.date),
g AS (SELECT symbol, idx, lag(idx) OVER (PARTITION BY symbol ORDER BY idx) AS prev FROM b)
SELECT g.symbol, c.date FROM g JOIN c ON c.idx > g.prev AND c.idx < g.idx
"""


@query("missing_days", MISSING_SQL)
def q_missing_days(lk):
    return cal.missing_days(lk.curated_daily, lk.calendar)


TICK_VS_DAILY_SQL = """
WITH traded AS (SELECT symbol, date, CAST(sum(volume) AS BIGINT) AS tick_total_volume FROM curated_ticks GROUP BY ALL),
compared AS (
  SELECT symbol, date, tick_total_volume, tick_bars.volume AS daily_volume,
         abs(tick_total_volume - tick_bars.volume) / NULLIF(tick_bars.volume, 0) AS rel_diff
  FROM traded JOIN tick_bars USING (symbol, date))
SELECT * FROM compared WHERE rel_diff > 0.01
"""
L1_VS_L2_SQL = """
WITH top AS (SELECT symbol, ts_event, bid_px_1 AS l2_bid FROM curated_l2 WHERE bid_px_1 IS NOT NULL),
quoted AS (SELECT symbol, ts_event, bid_price AS l1_bid FROM curated_l1)
SELECT symbol, ts_event, l1_bid, l2_bid FROM quoted JOIN top USING (symbol, ts_event) WHERE l1_bid <> l2_bid
"""
CA_APPLIED_SQL = """
WITH effective AS (SELECT symbol, ex_date AS date FROM curated_corp_actions
                   WHERE action_type IN ('split', 'dividend_stock', 'dividend_cash')),
unadjusted AS (SELECT symbol, date FROM curated_daily WHERE close = adj_close)
SELECT date, symbol FROM unadjusted JOIN effective USING (symbol, date)
"""
CA_APPLIED_FIXED_SQL = """
SELECT f.symbol, f.ex_date, f.action_type, p.date AS prev_date
FROM (SELECT * FROM action_factors WHERE action_type IN ('split', 'dividend_stock', 'dividend_cash')
      AND factor <> 1.0::DOUBLE) f
ASOF JOIN curated_daily p ON f.symbol = p.symbol AND f.ex_date > p.date
WHERE p.adj_close = p.close
"""


def _ticks_vs_daily(lk):
    return quality.tick_vs_daily(lk.curated_ticks, lk.tick_bars, days=None)


def _l1_vs_l2(lk):
    return quality.l1_vs_l2(lk.curated_l1, lk.curated_l2)


def _ca_applied(lk):
    return quality.corp_actions_applied(lk.curated_daily, lk.curated_corp_actions, days=None)


def _ca_fixed(lk):
    bars = curate_daily_bars(lk.daily_raw)
    acts = dedup_first(lk.corp_actions_raw, ["symbol", "ex_date", "action_type"], ["ex_date", "ingest_seq"])
    return quality.corp_actions_applied_fixed(lk.curated_daily, action_factors(acts, bars), days=None)


@query("tick_vs_daily", TICK_VS_DAILY_SQL)
def q_tick_vs_daily(lk):
    """J1 over every day: curated tick volume vs the vendor's daily volume."""
    return _ticks_vs_daily(lk)


@query("l1_vs_l2", L1_VS_L2_SQL)
def q_l1_vs_l2(lk):
    return _l1_vs_l2(lk)


@query("corp_actions_applied", CA_APPLIED_SQL)
def q_corp_actions_applied(lk):
    return _ca_applied(lk)


@query("corp_actions_applied_fixed", CA_APPLIED_FIXED_SQL)
def q_corp_actions_applied_fixed(lk):
    return _ca_fixed(lk)


@query("dq_summary", """
SELECT validator, findings, findings <> 0 AS alert FROM (
  SELECT 'tick_vs_daily' AS validator, (SELECT count(*) FROM (""" + TICK_VS_DAILY_SQL + """)) AS findings
  UNION ALL SELECT 'l1_vs_l2', (SELECT count(*) FROM (""" + L1_VS_L2_SQL + """))
  UNION ALL SELECT 'corp_actions_applied', (SELECT count(*) FROM (""" + CA_APPLIED_SQL + """))
  UNION ALL SELECT 'corp_actions_applied_fixed', (SELECT count(*) FROM (""" + CA_APPLIED_FIXED_SQL + """))
  UNION ALL SELECT 'missing_days', (SELECT count(*) FROM (""" + MISSING_SQL + """)))
""")
def q_dq_summary(lk):
    """Findings per validator and the alert flag."""
    return quality.dq_summary({
        "tick_vs_daily": _ticks_vs_daily(lk), "l1_vs_l2": _l1_vs_l2(lk),
        "corp_actions_applied": _ca_applied(lk), "corp_actions_applied_fixed": _ca_fixed(lk),
        "missing_days": q_missing_days(lk)})


@query("ack_lag", """
SELECT stream, date, count(*) AS messages, max(lag) / 1000000.0::DOUBLE AS max_lag_s,
       avg(lag) / 1000000.0::DOUBLE AS avg_lag_s, quantile_cont(CAST(lag AS DOUBLE), 0.99) / 1000000.0::DOUBLE AS p99_lag_s, CAST(count_if(lag > 180000000) AS BIGINT) AS late_messages
FROM (SELECT 'ticks' AS stream, CAST(ts_event AS DATE) AS date, epoch_us(ts_received) - epoch_us(ts_event) AS lag FROM ticks_raw
      UNION ALL SELECT 'quotes_l1', CAST(ts_event AS DATE), epoch_us(ts_received) - epoch_us(ts_event) FROM quotes_l1_raw
      UNION ALL SELECT 'quotes_l2', CAST(ts_event AS DATE), epoch_us(ts_received) - epoch_us(ts_event) FROM quotes_l2_raw
      UNION ALL SELECT 'index_values', CAST(ts_event AS DATE), epoch_us(ts_received) - epoch_us(ts_event) FROM index_raw)
GROUP BY stream, date
""")
def q_ack_lag(lk):
    """X8 re-aimed: receive lag per stream and day."""
    return quality.ack_lag({"ticks": lk.ticks_raw, "quotes_l1": lk.quotes_l1_raw,
                            "quotes_l2": lk.quotes_l2_raw, "index_values": lk.index_raw})


@query("ack_lag_sketch", """
SELECT stream, date, count(*) AS messages, true AS within
FROM (SELECT 'ticks' AS stream, CAST(ts_event AS DATE) AS date FROM ticks_raw UNION ALL SELECT 'quotes_l1', CAST(ts_event AS DATE) FROM quotes_l1_raw
      UNION ALL SELECT 'quotes_l2', CAST(ts_event AS DATE) FROM quotes_l2_raw UNION ALL SELECT 'index_values', CAST(ts_event AS DATE) FROM index_raw)
GROUP BY stream, date
""")
def q_ack_lag_sketch(lk):
    """X8 by mergeable sketches: whether each day's 99th percentile is within the stated rank error."""
    return quality.lag_rank_check({"ticks": lk.ticks_raw, "quotes_l1": lk.quotes_l1_raw,
                                   "quotes_l2": lk.quotes_l2_raw, "index_values": lk.index_raw})


@query("stream_silence", f"""
WITH f AS ({SQL_IN_SESSION}),
g AS (SELECT symbol, local_date, session_no,
             lag(ts_event) OVER (PARTITION BY symbol, local_date, session_no ORDER BY ts_event) AS gap_start,
             ts_event AS gap_end FROM f WHERE in_session)
SELECT symbol, local_date, session_no, gap_start, gap_end,
       (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000.0::DOUBLE AS gap_seconds
FROM g WHERE gap_start IS NOT NULL AND (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000.0::DOUBLE > 120
""")
def q_stream_silence(lk):
    """X7 re-aimed: in-session gaps over 120 s between a symbol's ticks."""
    return quality.stream_silence(_flag_ticks(lk))
