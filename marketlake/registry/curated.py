"""Curated layer: dedup, as-of, factors, adjustment, daily factors."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.prices import l1_derived
from ..operators import adjust, curate, dedup, factors
from ..sinks import lake as sink
from ..sources import lake as src
from . import query


@query("curate_daily_ohlcv", "SELECT * FROM curated_daily")
def q_curate_daily_ohlcv(lk):
    """Flagship: deduplicated daily bars with backward-adjusted close, from raw."""
    return lk.curated_daily_plan


@query("dedup_first", "SELECT * FROM daily_dedup")
def q_dedup_first(lk):
    """W7 on its own: first bar per (date, symbol) by landing order."""
    return curate.curate_daily_bars(lk.daily_raw)


@query("curate_corp_actions", "SELECT * FROM curated_corp_actions")
def q_curate_corp_actions(lk):
    return lk.curated_corp_actions_plan


@query("curate_ticks", "SELECT * FROM curated_ticks")
def q_curate_ticks(lk):
    return lk.curated_ticks_plan


@query("curate_quotes_l1", "SELECT * FROM curated_l1")
def q_curate_quotes_l1(lk):
    return lk.curated_l1_plan


@query("curate_quotes_l2", "SELECT * FROM curated_l2")
def q_curate_quotes_l2(lk):
    return lk.curated_l2_plan


@query("curate_indices", "SELECT * FROM curated_index")
def q_curate_indices(lk):
    return lk.curated_index_plan


@query("curate_fundamentals", "SELECT * FROM curated_fundamentals")
def q_curate_fundamentals(lk):
    return lk.curated_fundamentals_plan


@query("asof_prev_close", """
SELECT symbol, ex_date, action_type, close_prev FROM action_factors
""")
def q_asof_prev_close(lk):
    """Last close strictly before each ex_date, per symbol."""
    bars = curate.curate_daily_bars(lk.daily_raw)
    acts = dedup.dedup_first(lk.corp_actions_raw, ["symbol", "ex_date", "action_type"],
                             ["ex_date", "ingest_seq"])
    return adjust.asof_prev_close(acts, bars).select("symbol", "ex_date", "action_type", "close_prev")


@query("action_factor", """
SELECT symbol, ex_date, action_type, ratio, amount, close_prev, factor FROM action_factors
""")
def q_action_factor(lk):
    """P10: factor of every deduplicated action."""
    bars = curate.curate_daily_bars(lk.daily_raw)
    acts = dedup.dedup_first(lk.corp_actions_raw, ["symbol", "ex_date", "action_type"],
                             ["ex_date", "ingest_seq"])
    return adjust.action_factors(acts, bars)


@query("adjust_prices", "SELECT symbol, date, close, adj_close FROM curated_daily")
def q_adjust_prices(lk):
    """Range product of later factors, one output row per bar."""
    return lk.curated_daily_plan.select("symbol", "date", "close", "adj_close")


@query("l1_derived", """
SELECT symbol, ts_event, ts_received, bid_price, ask_price,
       CASE WHEN bid_price > 0 AND ask_price > 0 THEN (bid_price + ask_price) // 2 END AS mid_price,
       CASE WHEN bid_price > 0 AND ask_price > 0 THEN
            CAST(round_even(10000.0::DOUBLE * (ask_price - bid_price) / ((bid_price + ask_price) // 2), 0) AS INTEGER)
       END AS spread_bps
FROM quotes_l1_raw
""")
def q_l1_derived(lk):
    """P3 on raw quotes (before dedup)."""
    return l1_derived(lk.quotes_l1_raw).select("symbol", "ts_event", "ts_received", "bid_price",
                                               "ask_price", "mid_price", "spread_bps")


FACTORS_SQL = """
SELECT date, symbol, asset_class, exchange, close, adj_close, volume, value,
       (close - lag(close) OVER w) / NULLIF(lag(close) OVER w, 0) AS daily_return,
       (adj_close - lag(adj_close) OVER w) / NULLIF(lag(adj_close) OVER w, 0) AS adj_daily_return
FROM curated_daily
WINDOW w AS (PARTITION BY symbol ORDER BY date)
"""


@query("daily_factors", FACTORS_SQL)
def q_daily_factors(lk):
    """Simple returns on raw and adjusted closes."""
    return factors.daily_factors(lk.curated_daily)


@query("factors", f"""
SELECT * FROM ({FACTORS_SQL}) WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
""")
def q_factors(lk):
    """A date range over the factor view (filter stays above the lag)."""
    return factors.factors_between(lk.curated_daily, "1997-01-01", "1998-12-31")


@query("curate_daily_incremental", "SELECT * FROM curated_daily")
def q_curate_daily_incremental(lk):
    """L2 by what has changed: the bars and nine tenths of the actions are landed and curated, then the other actions are
    landed and taken up; the table as it is then."""
    from ..plans.daily import curate_daily
    root = lk.scratch("incremental")
    few = F.pmod(F.xxhash64("symbol", "ex_date", "action_type"), F.lit(10)) == 0
    sink.land_daily(lk.daily_raw, root)
    for part in (~few, few):
        sink.land_corp_actions(lk.corp_actions_raw.where(part), root)
        curate_daily(lk.spark, root)
    return src.curated_columns(lk.spark, root, "daily_ohlcv")


@query("land_ticks", "SELECT symbol, ts_event, trade_id, price, volume, ts_received FROM ticks_raw")
def q_land_ticks(lk):
    """A day's ticks landed, the same batch landed again, and read back with the declared schema."""
    root = lk.scratch("landing")
    for _ in range(2):
        sink.land_stream(lk.ticks_raw, root, "ticks", "7")
    return src.scan_raw(lk.spark, root, "ticks").select("symbol", "ts_event", "trade_id", "price", "volume", "ts_received")


@query("land_corp_actions", "SELECT symbol, ex_date, action_type, ratio, amount FROM corp_actions_raw")
def q_land_corp_actions(lk):
    """Actions landed by key in two parts, the second of them twice, and read back."""
    root = lk.scratch("landing")
    some = F.pmod(F.xxhash64("symbol", "ex_date", "action_type"), F.lit(3)) == 0
    for part in (some, ~some, ~some):
        sink.land_corp_actions(lk.corp_actions_raw.where(part), root)
    return src.scan_raw(lk.spark, root, "corp_actions").select("symbol", "ex_date", "action_type", "ratio", "amount")
