"""Research queries: stats, rankings, movers, KPIs, equity curves, reshapes."""

from __future__ import annotations

import datetime as dt


from ..operators import factors, research
from ..sources.universe import distinct_symbols, load_universe
from . import query

AS_OF = "(SELECT max(date) FROM curated_daily)"
EXCHANGES = ["HOSE", "HNX", "UPCoM"]


@query("lake_stats", """
SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbol_count,
       min(date) AS first_date, max(date) AS last_date FROM curated_daily
""")
def q_lake_stats(lk):
    return research.lake_stats(lk.curated_daily)


@query("top_volume", f"""
SELECT symbol, avg(volume) AS avg_volume, count(*) AS days FROM curated_daily
WHERE date >= {AS_OF} - 30 GROUP BY symbol ORDER BY avg_volume DESC, symbol LIMIT 25
""")
def q_top_volume(lk):
    return research.top_volume(lk.curated_daily)


@query("coverage_by_symbol", """
SELECT symbol, count(*) AS days, min(date) AS first_date, max(date) AS last_date
FROM curated_daily GROUP BY symbol ORDER BY days DESC, symbol
""")
def q_coverage_by_symbol(lk):
    return research.coverage_by_symbol(lk.curated_daily)


@query("best_performers", f"""
WITH this_year AS (SELECT symbol, date, close FROM curated_daily WHERE year(date) = year({AS_OF})),
ends AS (SELECT symbol, date = min(date) OVER s AS opens, date = max(date) OVER s AS closes, close
         FROM this_year WINDOW s AS (PARTITION BY symbol)),
pairs AS (SELECT symbol, max(close) FILTER (WHERE opens) AS was, max(close) FILTER (WHERE closes) AS now FROM ends GROUP BY symbol)
SELECT symbol, (now - was) / was * 100 AS ytd_pct FROM pairs WHERE was > 0
ORDER BY ytd_pct DESC, symbol LIMIT 25
""")
def q_best_performers(lk):
    return research.best_performers(lk.curated_daily)


@query("range_drawdown", f"""
SELECT symbol, list_max(closes) AS hi, list_min(closes) AS lo,
       (list_min(closes) - list_max(closes)) / list_max(closes) * 100 AS dd_pct
FROM (SELECT symbol, list(close) AS closes FROM curated_daily WHERE date_diff('day', date, {AS_OF}) <= 365 GROUP BY symbol)
WHERE list_max(closes) > 0 ORDER BY 4, symbol LIMIT 25
""")
def q_range_drawdown(lk):
    return research.range_drawdown(lk.curated_daily)


MOVERS_SQL = f"""
SELECT symbol, last_row.date AS last_date, last_row.close AS last_close, first_row.close AS ref_close,
       last_row.volume AS last_volume, avg_vol,
       (last_row.close - first_row.close) / NULLIF(first_row.close, 0) * 100 AS pct_change
FROM (SELECT symbol, arg_max({{'date': date, 'close': close, 'volume': volume}}, date) AS last_row,
             arg_min({{'date': date, 'close': close, 'volume': volume}}, date) AS first_row,
             avg(volume) AS avg_vol
      FROM curated_daily WHERE date BETWEEN {AS_OF} - 30 AND {AS_OF} GROUP BY symbol)
WHERE avg_vol >= 20 AND first_row.close > 0
"""


def _movers(lk):
    return research.movers(lk.curated_daily, interval_days=30, min_vol=20)


@query("movers", MOVERS_SQL)
def q_movers(lk):
    """30-day movers with an average-volume floor of 20."""
    return _movers(lk)


@query("breadth", f"""
SELECT count(*) AS symbols, CAST(count_if(pct_change > 0) AS BIGINT) AS gainers,
       CAST(count_if(pct_change < 0) AS BIGINT) AS losers,
       max(last_date) AS latest_date FROM ({MOVERS_SQL})
""")
def q_breadth(lk):
    return research.breadth(_movers(lk))


@query("top_gainers", f"SELECT * FROM ({MOVERS_SQL}) ORDER BY pct_change DESC, symbol LIMIT 15")
def q_top_gainers(lk):
    return research.top_k(_movers(lk), "pct_change", 15)


@query("top_losers", f"SELECT * FROM ({MOVERS_SQL}) ORDER BY pct_change ASC, symbol LIMIT 15")
def q_top_losers(lk):
    return research.top_k(_movers(lk), "pct_change", 15, descending=False)


@query("volume_leaders", f"SELECT * FROM ({MOVERS_SQL}) ORDER BY avg_vol DESC, symbol LIMIT 15")
def q_volume_leaders(lk):
    return research.top_k(_movers(lk), "avg_vol", 15)


SERIES_SQL = """
SELECT {key}, date, {v}, {extra}
       (CAST({v} AS DOUBLE) - CAST(lag({v}) OVER w AS DOUBLE)) / NULLIF(CAST(lag({v}) OVER w AS DOUBLE), 0) AS ret,
       max({v}) OVER (PARTITION BY {key} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY date)
"""


@query("symbol_kpis", f"""
WITH r AS ({SERIES_SQL.format(key='symbol', v='close', extra='volume,', src='curated_daily')})
SELECT symbol, arg_max(close, date) AS last,
       (arg_max(close, date) - arg_min(close, date)) / NULLIF(arg_min(close, date), 0) * 100 AS period_pct,
       min((close - peak) / CAST(peak AS DOUBLE)) * 100 AS max_dd_pct,
       round(CASE WHEN stddev_samp(ret) > 0 AND count(ret) > 1
                  THEN avg(ret) / stddev_samp(ret) * sqrt(252.0::DOUBLE) ELSE 0.0::DOUBLE END, 9) AS sharpe,
       avg(volume) AS avg_volume
FROM r GROUP BY symbol
""")
def q_symbol_kpis(lk):
    return research.symbol_kpis(lk.curated_daily)


@query("symbol_summary", """
SELECT symbol, arg_max(close, date) AS last_close,
       (arg_max(close, date) - arg_min(close, date)) / NULLIF(arg_min(close, date), 0) * 100 AS change_pct,
       max(high) AS period_high, min(low) AS period_low, avg(volume) AS avg_volume
FROM curated_daily GROUP BY symbol
""")
def q_symbol_summary(lk):
    return research.symbol_summary(lk.curated_daily)


@query("equity_stats", f"""
WITH r AS ({SERIES_SQL.format(key='strategy', v='equity', extra='', src='equity_curve')}),
g AS (SELECT strategy, arg_max(equity, date) / NULLIF(arg_min(equity, date), 0) - 1 AS total_return,
             min((equity - peak) / NULLIF(peak, 0)) AS max_drawdown,
             round(CASE WHEN stddev_samp(ret) > 0 THEN avg(ret) / stddev_samp(ret) * sqrt(252.0::DOUBLE)
                        ELSE 0.0::DOUBLE END, 9) AS sharpe,
             greatest(date_diff('day', min(date), max(date)), 1) AS days
      FROM r GROUP BY strategy)
SELECT strategy, total_return, round(pow(1 + total_return, 365.0::DOUBLE / days) - 1, 9) AS cagr,
       max_drawdown, sharpe FROM g
""")
def q_equity_stats(lk):
    return research.equity_stats(lk.equity_curve)


@query("returns", """
SELECT symbol, date, close,
       (CAST(close AS DOUBLE) - CAST(lag(close) OVER w AS DOUBLE)) / NULLIF(CAST(lag(close) OVER w AS DOUBLE), 0) AS ret
FROM curated_daily WINDOW w AS (PARTITION BY symbol ORDER BY date)
""")
def q_returns(lk):
    return factors.returns(lk.curated_daily.select("symbol", "date", "close"), "symbol", "close")


@query("drawdown", """
SELECT symbol, date, close, peak, (close - peak) / CAST(peak AS DOUBLE) AS drawdown
FROM (SELECT symbol, date, close, max(close) OVER (PARTITION BY symbol ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM curated_daily)
""")
def q_drawdown(lk):
    return factors.drawdown(lk.curated_daily.select("symbol", "date", "close"), "symbol", "close")


@query("indexed_returns", """
SELECT symbol, date, close, close / NULLIF(first_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) * 100 AS indexed
FROM curated_daily
""")
def q_indexed_returns(lk):
    return research.indexed(lk.curated_daily)


@query("recent_bars", """
SELECT date, symbol, open, high, low, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM curated_daily) WHERE rn <= 250
""")
def q_recent_bars(lk):
    return research.recent_bars(lk.curated_daily, 250)


@query("union_sources", """
SELECT date, symbol, asset_class, exchange, open, high, low, close, volume, value,
       foreign_buy_vol, foreign_sell_vol FROM daily_dedup
UNION ALL
SELECT date, symbol, asset_class, exchange, open, high, low, close, volume, value,
       NULL::BIGINT, NULL::BIGINT FROM tick_bars
""")
def q_union_sources(lk):
    """Bars from two sources with different column sets, by name."""
    from ..operators.curate import curate_daily_bars
    return curate_daily_bars(lk.daily_raw).unionByName(lk.tick_bars, allowMissingColumns=True)


@query("distinct_symbols", "SELECT DISTINCT symbol FROM curated_daily ORDER BY symbol")
def q_distinct_symbols(lk):
    return distinct_symbols(lk.curated_daily)


@query("pivot_close", "SELECT date, " + ", ".join(
    f"avg(close) FILTER (WHERE exchange = '{e}') AS \"{e}\"" for e in EXCHANGES)
    + " FROM curated_daily GROUP BY date")
def q_pivot_close(lk):
    """Date x exchange mean close (pivot values are the fixed exchange list)."""
    return research.pivot_mean(lk.curated_daily, "date", "exchange", EXCHANGES, "close")


SELECTION = ["S1", "S2", "S3", "S4", "S5"]


@query("symbol_matrix", "SELECT date, " + ", ".join(
    f"avg(close) FILTER (WHERE symbol = '{e}') AS \"{e}\"" for e in SELECTION)
    + " FROM curated_daily WHERE symbol IN (" + ", ".join(f"'{e}'" for e in SELECTION) + ") GROUP BY date")
def q_symbol_matrix(lk):
    """Date x symbol closes of a selection."""
    return research.symbol_matrix(lk.curated_daily, SELECTION)


@query("melt_close", """
SELECT date, symbol, avg(close) AS close FROM curated_daily WHERE symbol IN ('S1', 'S2', 'S3', 'S4', 'S5') GROUP BY ALL
""")
def q_melt_close(lk):
    """The selection's matrix melted back to long form."""
    return research.unpivot_mean(research.symbol_matrix(lk.curated_daily, SELECTION), "date", SELECTION, "symbol", "close")


@query("load_universe", """
SELECT DISTINCT upper(trim(coalesce(json_extract_string(value, '$.symbol'),
       CASE WHEN trim(value) LIKE '"%' THEN json_extract_string(value, '$') END))) AS symbol
FROM universe_lines
WHERE json_valid(value) AND trim(value) <> ''
  AND coalesce(json_extract_string(value, '$.symbol'),
               CASE WHEN trim(value) LIKE '"%' THEN json_extract_string(value, '$') END) IS NOT NULL
ORDER BY symbol
""")
def q_load_universe(lk):
    return load_universe(lk.universe_lines)




@query("sql", """
SELECT symbol, count(*) AS days, max(close) AS max_close FROM curated_daily
WHERE date >= DATE '1998-01-01' GROUP BY symbol
""")
def q_sql(lk):
    """User SQL over the session's views, with bound parameters (no string pasting)."""
    from ..sources.lake import run_sql
    lk.curated_daily.createOrReplaceTempView("curated_daily")
    return run_sql(lk.spark, "SELECT symbol, count(*) AS days, max(close) AS max_close FROM curated_daily "
                             "WHERE date >= :start GROUP BY symbol", start=dt.date(1998, 1, 1))
