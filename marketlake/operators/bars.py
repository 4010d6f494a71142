"""Aggregations over ticks and index snapshots, and the SDK-style reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_READ_COLS = ["date", "symbol", "asset_class", "exchange", "open", "high", "low", "close",
                   "volume", "value"]


def session_vwap(ticks: DataFrame) -> DataFrame:
    """Per (symbol, asset_class, exchange, date): VWAP, volume, count, first/last ts (G1).

    price*volume is summed as decimal(38,0) so a busy day cannot overflow a
    long; the division happens once, in double.  Partial aggregation runs
    map-side, so a hot symbol costs one small partial row per task.
    """
    pv = (F.col("price").cast("decimal(38,0)") * F.col("volume").cast("decimal(38,0)"))
    return ticks.groupBy("symbol", "asset_class", "exchange", "date").agg(
        F.try_divide(F.sum(pv).cast("double"), F.nullif(F.sum("volume"), F.lit(0))).alias("vwap_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("tick_count"),
        F.min("ts_event").alias("first_tick_ts"),
        F.max("ts_event").alias("last_tick_ts"),
    )


def index_daily(index: DataFrame) -> DataFrame:
    """Last value / change / change_pct per (date, index_code) by event time."""
    last = F.max_by(F.struct("value", "change", "change_pct"), F.struct("ts_event", "ts_received"))
    return (index.groupBy(F.to_date("ts_event").alias("date"), "index_code")
            .agg(last.alias("_l"))
            .select("date", "index_code", "_l.value", "_l.change", "_l.change_pct"))


def index_intraday(index: DataFrame, code: str | None, start: str, end: str) -> DataFrame:
    """Snapshots of one code (or all) in the inclusive date range [start, end]."""
    lo = F.lit(start).cast("date").cast("timestamp")
    hi = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    out = index.where((F.col("ts_event") >= lo) & (F.col("ts_event") < hi))
    if code is not None:
        out = out.where(F.col("index_code") == code)
    return out


def daily(bars: DataFrame, symbols: Sequence[str] | DataFrame | None, start: str, end: str) -> DataFrame:
    """Bars for a symbol list (literal list or a frame of symbols) and date range.

    A literal list becomes an IN filter pushed into the scan; a frame of
    symbols becomes a semi join.
    """
    out = bars.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if isinstance(symbols, DataFrame):
        out = out.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    elif symbols is not None:
        out = out.where(F.col("symbol").isin(list(symbols)))
    return out.select(*DAILY_READ_COLS).orderBy("symbol", "date")


def ticks_on(ticks: DataFrame, on_date: str, symbol: str | None = None) -> DataFrame:
    """Ticks of one day (and optionally one symbol): a partition-pruned read."""
    out = ticks.where(F.col("date") == F.lit(on_date).cast("date"))
    if symbol is not None:
        out = out.where(F.col("symbol") == symbol)
    return out


def latest_snapshot(ref: DataFrame, snapshot_col: str = "snapshot") -> DataFrame:
    """Rows of the newest snapshot (A19).  The max is resolved first so the
    filter is a literal and prunes snapshot partitions at scale."""
    latest = ref.agg(F.max(snapshot_col)).first()[0]
    return ref.where(F.col(snapshot_col) == F.lit(latest))


def max_value(df: DataFrame, col: str):
    """One scalar (e.g. the as-of date) resolved on the driver."""
    return df.agg(F.max(col)).first()[0]
