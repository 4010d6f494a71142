"""The seven curators: dedup with a total tie-break, plus derived columns.

Each returns the curated frame; writing is separate (`sinks.lake`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.prices import l1_derived
from .adjust import adjust_prices
from .dedup import dedup_first

DAILY_COLS = ["date", "symbol", "asset_class", "exchange", "open", "high", "low", "close",
              "volume", "value", "foreign_buy_vol", "foreign_sell_vol"]
ACTION_COLS = ["ex_date", "record_date", "payment_date", "symbol", "action_type", "ratio", "amount"]
TICK_COLS = [f.name for f in schemas.TICK.fields] + ["date"]
L1_COLS = [f.name for f in schemas.QUOTE_L1.fields] + ["mid_price", "spread_bps", "date"]
L2_COLS = [f.name for f in schemas.QUOTE_L2.fields] + ["date", "hour"]
INDEX_COLS = [f.name for f in schemas.INDEX_VALUE.fields] + ["date"]
FUND_COLS = ["as_of_date", "symbol", "period", "pe", "pb", "eps", "bvps", "roe", "roa",
             "debt_to_equity", "market_cap", "revenue", "net_income", "total_assets", "total_equity"]
TICKER_COLS = ["symbol", "name", "exchange", "asset_class", "sector_l1", "sector_l2", "industry", "status",
               "listed_date", "lot_size", "tick_size", "foreign_room_pct", "snapshot"]
FUTURE_COLS = ["symbol", "underlying_index", "expiry_date", "contract_size", "tick_size", "margin_pct", "snapshot"]


def curate_corp_actions(raw: DataFrame) -> DataFrame:
    """One row per (symbol, ex_date, action_type); first landed wins."""
    return dedup_first(raw, ["symbol", "ex_date", "action_type"],
                       ["ex_date", "ingest_seq"]).select(*ACTION_COLS)


def curate_daily_bars(raw: DataFrame) -> DataFrame:
    """One bar per (date, symbol); the 1900 placeholder date is dropped."""
    return dedup_first(raw.where(F.year("date") != 1900), ["date", "symbol"],
                       ["date", "ingest_seq"]).select(*DAILY_COLS)


def curate_daily_ohlcv(raw: DataFrame, actions_raw: DataFrame) -> DataFrame:
    """Deduplicated bars with backward-adjusted close.

    Actions are deduplicated first: the daily sweep re-lands future actions,
    and applying one twice would compound its factor.  Both inputs are
    deduplicated on their full keys, with the group limit below the shuffle, so
    deliveries of a symbol that repeat are cut map-side and spread over
    its days; only then do the remaining rows, bounded by the calendar, meet
    by symbol in one shuffle.
    """
    bars = curate_daily_bars(raw)
    acts = dedup_first(actions_raw, ["symbol", "ex_date", "action_type"], ["ex_date", "ingest_seq"])
    return adjust_prices(bars, acts).select(*DAILY_COLS, "adj_close")


def curate_ticks(raw: DataFrame) -> DataFrame:
    """(symbol, ts_event, trade_id) unique; earliest arrival wins."""
    return dedup_first(raw, ["symbol", "ts_event", "trade_id"],
                       ["ts_event", "ts_received", "seq", "price"]).select(*TICK_COLS)


def curate_quotes_l1(raw: DataFrame) -> DataFrame:
    d = dedup_first(raw, ["symbol", "ts_event"], ["ts_event", "ts_received", "ingest_seq", "bid_size"])
    return l1_derived(d).select(*L1_COLS)


def curate_quotes_l2(raw: DataFrame) -> DataFrame:
    """(symbol, ts_event) unique; earliest arrival wins, then landing order
    (arrival time and message id identify a delivery)."""
    return dedup_first(raw, ["symbol", "ts_event"], ["ts_event", "ts_received", "ingest_seq"]).select(*L2_COLS)


def curate_indices(raw: DataFrame) -> DataFrame:
    return dedup_first(raw, ["index_code", "ts_event"],
                       ["ts_event", "ts_received", "ingest_seq"]).select(*INDEX_COLS)


def curate_fundamentals(raw: DataFrame) -> DataFrame:
    """(symbol, period) unique; earliest as_of_date wins, then landing order."""
    return dedup_first(raw, ["symbol", "period"], ["as_of_date", "ingest_seq"]).select(*FUND_COLS)


def curate_tickers(raw: DataFrame) -> DataFrame:
    """(symbol, snapshot) unique; the row with the first name wins."""
    return dedup_first(raw, ["symbol", "snapshot"], [F.col(c).asc_nulls_last() for c in TICKER_COLS if c not in (
        "symbol", "snapshot")]).select(*TICKER_COLS)


def curate_futures(raw: DataFrame) -> DataFrame:
    """(symbol, snapshot) unique."""
    return dedup_first(raw, ["symbol", "snapshot"], [F.col(c).asc_nulls_last() for c in FUTURE_COLS if c not in (
        "symbol", "snapshot")]).select(*FUTURE_COLS)
