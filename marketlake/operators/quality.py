"""Data-quality validators (J1-J3), latency (X8), silence (X7) and the summary.

Each validator returns its findings as rows; zero rows means healthy.  The
date window is a parameter (None = every day in the tables).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .asof import asof_backward, asof_measured


def _since(df: DataFrame, days: int | None, as_of=None, col: str = "date") -> DataFrame:
    if days is None:
        return df
    if as_of is None:
        as_of = df.agg(F.max(col)).first()[0]
    return df.where(F.col(col) >= F.lit(str(as_of - dt.timedelta(days=days))).cast("date"))


def tick_vs_daily(ticks: DataFrame, daily: DataFrame, days: int | None = 7, as_of=None,
                  tolerance: float = 0.01) -> DataFrame:
    """Tick volume per (symbol, date) vs the daily bar's volume; flag > tolerance."""
    t = (_since(ticks, days, as_of).groupBy("symbol", "date")
         .agg(F.sum("volume").alias("tick_total_volume")))
    d = daily.select("symbol", "date", F.col("volume").alias("daily_volume"))
    rel = F.try_divide(F.abs(F.col("tick_total_volume") - F.col("daily_volume")),
                       F.nullif(F.col("daily_volume"), F.lit(0)))
    return (t.join(d, ["symbol", "date"]).withColumn("rel_diff", rel)
            .where(F.col("rel_diff") > tolerance)
            .select("symbol", "date", "tick_total_volume", "daily_volume", "rel_diff"))


def l1_vs_l2(l1: DataFrame, l2: DataFrame, on_date=None) -> DataFrame:
    """L1 best bid differs from L2 level-1 bid at the same instant.
    `!=` with a null side drops the row, as in the reference check."""
    a = l1 if on_date is None else l1.where(F.col("date") == F.lit(str(on_date)).cast("date"))
    b = l2.select("symbol", "ts_event", F.col("bid_px_1").alias("l2_bid"))
    if on_date is not None:
        b = b.where(F.to_date("ts_event") == F.lit(str(on_date)).cast("date"))
    return (a.select("symbol", "ts_event", F.col("bid_price").alias("l1_bid"))
            .join(b, ["symbol", "ts_event"]).where(F.col("l1_bid") != F.col("l2_bid")))


CHECKED_ACTIONS = ["split", "dividend_stock", "dividend_cash"]


def corp_actions_applied(daily: DataFrame, actions: DataFrame, days: int | None = 30, as_of=None) -> DataFrame:
    """Literal check: bars dated on an ex_date whose adj_close equals close.
    Note the ex-date bar is not adjusted by its own action, so the newest
    action of a symbol always shows up here."""
    d = _since(daily, days, as_of)
    a = actions.where(F.col("action_type").isin(CHECKED_ACTIONS)).select(
        "symbol", F.col("ex_date").alias("date"))
    return (d.where(F.col("adj_close") == F.col("close")).select("date", "symbol")
            .join(a, ["symbol", "date"]).select("date", "symbol"))


def corp_actions_applied_fixed(daily: DataFrame, factors: DataFrame, days: int | None = 30,
                               as_of=None) -> DataFrame:
    """Corrected check: the last bar before an effective action (factor != 1)
    must carry an adjusted close; flag when adj_close == close."""
    f = factors.where(F.col("action_type").isin(CHECKED_ACTIONS) & (F.col("factor") != 1.0))
    f = _since(f, days, as_of, col="ex_date")
    # a null symbol or date is no bar's key, as in a join
    prev = daily.where("symbol is not null and date is not null").select(
        "symbol", F.col("date").alias("prev_date"), F.col("close").alias("prev_close"), F.col("adj_close").alias("prev_adj_close"))
    j = asof_backward(f.select("symbol", "ex_date", "action_type"), prev, by=["symbol"],
                      left_key="ex_date", right_key="prev_date",
                      values=["prev_date", "prev_close", "prev_adj_close"], strict=True,
                      bucket=lambda c: F.trunc(c, "year"))
    return (j.where(F.col("prev_adj_close") == F.col("prev_close"))
            .select("symbol", "ex_date", "action_type", "prev_date"))


def dq_summary(findings: dict) -> DataFrame:
    """One row per validator: findings and whether to alert.

    Values are DataFrames or zero-argument callables building them.  Each is counted by a job
    of its own, so one that fails, while planning or running, reports -1 and the others
    still report."""
    counted, spark = [], None
    for name, v in findings.items():
        try:
            df = v() if callable(v) else v
            spark = spark or df.sparkSession
            counted.append((name, df.count()))
        except Exception:  # noqa: BLE001 - the failure is the finding
            counted.append((name, -1))
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame(counted, "validator string, findings long").withColumn("alert", F.col("findings") != 0)


def ack_lag(streams: dict[str, DataFrame], threshold_s: int = 180) -> DataFrame:
    """Per stream and day: messages, max, mean and 99th percentile of the receive lag, late messages."""
    parts = []
    for name, df in streams.items():
        lag_us = F.unix_micros("ts_received") - F.unix_micros("ts_event")
        parts.append(df.select(F.lit(name).alias("stream"), F.to_date("ts_event").alias("date"),
                               lag_us.alias("_lag")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("stream", "date").agg(
        F.count(F.lit(1)).alias("messages"),
        (F.max("_lag") / 1000000.0).alias("max_lag_s"),
        (F.avg("_lag") / 1000000.0).alias("avg_lag_s"),
        (F.percentile("_lag", F.lit(0.99)) / 1000000.0).alias("p99_lag_s"),
        F.count_if(F.col("_lag") > threshold_s * 1000000).alias("late_messages"))


#: Rank error of a sketch of K items: the true rank of its answer is within this of the rank asked for, in 99 of 100 cases.
SKETCH_K, SKETCH_ERROR = 800, 0.005


def lag_sketches(streams: dict[str, DataFrame]) -> DataFrame:
    """(stream, date, lags): a KLL sketch of the receive lags in microseconds, some kilobytes whatever the
    number of messages; sketches of days or batches are merged by `lag_quantiles` (X8)."""
    parts = None
    for name, df in streams.items():
        one = df.select(F.lit(name).alias("stream"), F.to_date("ts_event").alias("date"),
                        (F.unix_micros("ts_received") - F.unix_micros("ts_event")).alias("_lag"))
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy("stream", "date").agg(F.kll_sketch_agg_bigint("_lag", SKETCH_K).alias("lags"))


def lag_quantiles(sketches: DataFrame, by: list[str], rank: float = 0.99) -> DataFrame:
    """(by, messages, lag_us): the lag of `rank` over all sketches of a group."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("lags", SKETCH_K).alias("_s"))
    return merged.select(*by, F.kll_sketch_get_n_bigint("_s").alias("messages"), F.kll_sketch_get_quantile_bigint("_s", F.lit(rank)).alias("lag_us"))


def lag_rank_check(streams: dict[str, DataFrame], rank: float = 0.99, error: float = SKETCH_ERROR) -> DataFrame:
    """(stream, date, messages, within): whether the sketched lag of each stream's day is within `error` of the rank
    asked for, by counting the lags below and up to it."""
    answers = lag_quantiles(lag_sketches(streams), ["stream", "date"], rank).withColumnRenamed("messages", "_n")
    parts = None
    for name, df in streams.items():
        one = df.select(F.lit(name).alias("stream"), F.to_date("ts_event").alias("date"),
                        (F.unix_micros("ts_received") - F.unix_micros("ts_event")).alias("_lag"))
        parts = one if parts is None else parts.unionByName(one)
    # one answer for each stream and day
    c = parts.join(F.broadcast(answers), ["stream", "date"]).groupBy("stream", "date").agg(
        F.count(F.lit(1)).alias("messages"), F.max("_n").alias("_n"), F.count_if(F.col("_lag") < F.col("lag_us")).alias("_below"),
        F.count_if(F.col("_lag") <= F.col("lag_us")).alias("_upto"))
    ok = (F.col("_n") == F.col("messages")) & (F.col("_below") / F.col("messages") <= rank + error) & (F.col("_upto") / F.col("messages") >= rank - error)
    return c.select("stream", "date", "messages", ok.alias("within"))


def stream_silence(flagged: DataFrame, threshold_s: int = 120) -> DataFrame:
    """Gaps longer than `threshold_s` between consecutive in-session messages of
    a symbol within the same session (X7).  `flagged` comes from `in_session`.

    The previous message is a strict self as-of join over measured ranges, so one
    busy symbol-session is spread over many tasks instead of one `lag` window;
    ticks sharing a timestamp yield the same gap, kept once.
    """
    s = flagged.where("in_session").select("symbol", "local_date", "session_no", "ts_event")
    prev = asof_measured(s, s.select("symbol", "local_date", "session_no", F.col("ts_event").alias("_pts")),
                         by=["symbol", "local_date", "session_no"], left_key="ts_event", right_key="_pts", values=["_pts"], strict=True)
    g = prev.where(F.col("_pts").isNotNull()).select(
        "symbol", "local_date", "session_no", F.col("_pts").alias("gap_start"), F.col("ts_event").alias("gap_end"))
    secs = (F.unix_micros("gap_end") - F.unix_micros("gap_start")) / 1000000.0
    return g.withColumn("gap_seconds", secs).where(F.col("gap_seconds") > threshold_s).distinct()
