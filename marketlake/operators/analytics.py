"""Analytics the reference's design promises.

Windows are per symbol over daily rows (bounded by calendar length) or per
(symbol, day, session) over intraday rows; cross-sectional ranks are per
date (bounded by the universe size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EXCHANGE_ZONE
from .asof import asof_measured


def atr_gap_range(daily: DataFrame, n: int = 14) -> DataFrame:
    """Overnight gap, intraday range, true range and its n-day average (M1)."""
    w = Window.partitionBy("symbol").orderBy("date")
    prev = F.lag("close").over(w)
    x = daily.select("symbol", "date", "open", "high", "low", "close", prev.alias("prev_close"))
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev_close")),
                    F.abs(F.col("low") - F.col("prev_close")))
    x = x.select("symbol", "date", (F.col("open") - F.col("prev_close")).alias("gap"),
                 (F.col("high") - F.col("low")).alias("range"), tr.alias("true_range"))
    return x.withColumn("atr", F.avg("true_range").over(w.rowsBetween(-(n - 1), 0)))


def vwap_by_session(flagged_ticks: DataFrame) -> DataFrame:
    """VWAP per (symbol, local day, session) from in-session ticks (M2)."""
    pv = F.col("price").cast("decimal(38,0)") * F.col("volume").cast("decimal(38,0)")
    return (flagged_ticks.where("in_session").groupBy("symbol", "local_date", "session_no")
            .agg(F.try_divide(F.sum(pv).cast("double"), F.nullif(F.sum("volume"), F.lit(0))).alias("vwap_price"),
                 F.sum("volume").alias("total_volume"), F.count(F.lit(1)).alias("tick_count")))


def sector_heatmap(daily: DataFrame, tickers: DataFrame) -> DataFrame:
    """Per (date, sector): mean daily return, foreign net buy, gainers and losers (M3).
    The return is computed in the same pass as the flows (one window, no self
    join); tickers are one row per listed symbol (universe-sized)."""
    w = Window.partitionBy("symbol").orderBy("date")
    prev = F.lag("close").over(w)
    f = (daily.select("symbol", "date", "foreign_buy_vol", "foreign_sell_vol",
                      F.try_divide(F.col("close") - prev, F.nullif(prev, F.lit(0))).alias("daily_return"))
         .join(tickers.select("symbol", "sector_l1"), "symbol", "left"))
    return f.groupBy("date", "sector_l1").agg(
        F.avg("daily_return").alias("mean_return"),
        F.sum(F.col("foreign_buy_vol") - F.col("foreign_sell_vol")).alias("foreign_net_buy"),
        F.count_if(F.col("daily_return") > 0).alias("gainers"),
        F.count_if(F.col("daily_return") < 0).alias("losers"))


def futures_basis(future_ticks: DataFrame, index: DataFrame, index_code: str) -> DataFrame:
    """Future trade price (points) minus the underlying index level in force at
    the trade, same day (M4; as-of inclusive).  The level is the same for all symbols, so the day is the
    key and its rows are cut into measured ranges."""
    day = F.to_date("ts_event")
    p = future_ticks.select("symbol", "ts_event", "trade_id", "price", day.alias("_d"))
    idx = index.where(F.col("index_code") == index_code).select(day.alias("_d"), F.col("ts_event").alias("_its"), F.col("value").alias("index_value"))
    j = asof_measured(p, idx, by=["_d"], left_key="ts_event", right_key="_its", values=["index_value"], strict=False)
    return j.select("symbol", "ts_event", "trade_id", "price", "index_value",
                    (F.col("price") / 100.0 - F.col("index_value")).alias("basis"))


def spread_imbalance(l1: DataFrame, l2: DataFrame) -> DataFrame:
    """Mean quoted spread and level-1 book imbalance per (symbol, date) (M5)."""
    s = l1.groupBy("symbol", "date").agg(F.avg("spread_bps").alias("avg_spread_bps"))
    imb = F.try_divide((F.col("bid_sz_1") - F.col("ask_sz_1")).cast("double"),
                       F.nullif(F.col("bid_sz_1") + F.col("ask_sz_1"), F.lit(0)))
    b = l2.groupBy("symbol", "date").agg(F.avg(imb).alias("avg_imbalance"))
    return s.join(b, ["symbol", "date"], "full")


def gap_filled(ticks: DataFrame, gaps: DataFrame, stream: str = "ticks") -> DataFrame:
    """Daily tick counts with recorded gap days shown explicitly (M6): a gap
    day with no data appears with a null count and its reason."""
    counts = ticks.groupBy("date").agg(F.count(F.lit(1)).alias("ticks"))
    end = F.coalesce("end", "start")
    g = (gaps.where((F.col("stream") == stream) & F.col("start").isNotNull() & (end >= F.col("start")))
         .select(F.explode(F.sequence(F.col("start"), end)).alias("date"), "reason")
         .groupBy("date").agg(F.min("reason").alias("gap_reason")))
    return counts.join(g, "date", "full")


def merged_gaps(gaps: DataFrame, stream: str) -> DataFrame:
    """(gap_start, gap_end, reasons): the recorded gaps of a stream with overlapping and adjoining ones merged.

    Distinct gaps are swept in order of their start; a gap that starts more than a day after the greatest end so far
    begins a new stretch.  Stretches are disjoint, so there are fewer of them than days.
    """
    end = F.coalesce("end", "start")
    g = gaps.where((F.col("stream") == stream) & F.col("start").isNotNull() & (end >= F.col("start"))).select(
        "start", end.alias("end"), F.coalesce("reason", F.lit("")).alias("reason"))
    # one row per first day keeps the sweep's single task to the calendar's length
    g = g.groupBy("start").agg(F.max("end").alias("end"), F.collect_set("reason").alias("reasons"))
    sweep = Window.partitionBy(F.lit(1)).orderBy("start")
    reach = F.max("end").over(sweep.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start") > F.date_add(reach, 1)), 1).otherwise(0)
    g = g.withColumn("_new", new).withColumn("_no", F.sum("_new").over(sweep))
    return g.groupBy("_no").agg(F.min("start").alias("gap_start"), F.max("end").alias("gap_end"), F.array_join(F.array_sort(
        F.array_distinct(F.flatten(F.collect_list("reasons")))), "; ").alias("reasons")).drop("_no")


def gap_filled_by_symbol(ticks: DataFrame, gaps: DataFrame, stream: str = "ticks") -> DataFrame:
    """Ticks per symbol and day, with a null count for every day of a recorded gap within the symbol's own
    span that has none (M6): (symbol, date, ticks, gap_start, gap_end, reasons)."""
    counts = ticks.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("ticks"))
    spans = counts.groupBy("symbol").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    # disjoint stretches of days: bounded by the calendar
    cut = spans.join(F.broadcast(merged_gaps(gaps, stream)), (F.col("gap_start") <= F.col("_hi")) & (F.col("gap_end") >= F.col("_lo")))
    days = cut.select("symbol", F.explode(F.sequence(F.greatest("gap_start", "_lo"), F.least("gap_end", "_hi"))).alias("date"),
                      "gap_start", "gap_end", "reasons")
    return counts.join(days, ["symbol", "date"], "full")


def plan_fetches(seen: DataFrame, streams: list[str]) -> DataFrame:
    """(stream, symbol, date): every day between a symbol's first and last, for each stream."""
    span = seen.groupBy("symbol").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return span.select("symbol", F.explode(F.sequence("lo", "hi")).alias("date")).select(
        F.explode(F.array(*[F.lit(s) for s in streams])).alias("stream"), "symbol", "date")


def skip_present(planned: DataFrame, receipts: DataFrame) -> DataFrame:
    """(stream, symbol, date) triples still to fetch: planned minus those with receipts (M8)."""
    keys = ["stream", "symbol", "date"]
    return planned.join(receipts.select(*keys).distinct(), keys, "left_anti")


def momentum(daily: DataFrame, lookback: int = 20, buckets: int = 5) -> DataFrame:
    """lookback-row return per symbol and its cross-sectional quintile per date."""
    w = Window.partitionBy("symbol").orderBy("date")
    past = F.lag("close", lookback).over(w)
    m = daily.select("symbol", "date", F.try_divide(F.col("close") - past, F.nullif(past, F.lit(0)))
                     .alias("momentum")).where(F.col("momentum").isNotNull())
    xs = Window.partitionBy("date").orderBy(F.col("momentum"), F.col("symbol"))
    return m.withColumn("quintile", F.ntile(buckets).over(xs))


def spread_decay(flagged_l1: DataFrame) -> DataFrame:
    """Mean quoted spread by session and exchange-clock hour."""
    return (flagged_l1.where("in_session")
            .groupBy("session_no", F.hour(F.from_utc_timestamp("ts_event", EXCHANGE_ZONE)).alias("local_hour"))
            .agg(F.avg("spread_bps").alias("avg_spread_bps"), F.count(F.lit(1)).alias("quotes")))
