"""Scalar expressions on prices and symbols (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .. import schemas


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_symbol(symbol: str | Column) -> Column:
    """'future' for futures-style symbols, else 'equity' (P1)."""
    s = col(symbol)
    cond = None
    for p in schemas.FUTURE_PREFIXES:
        c = s.startswith(p)
        cond = c if cond is None else (cond | c)
    return F.when(cond, F.lit("future")).otherwise(F.lit("equity"))


def epoch_to_ts(ms: str | Column) -> Column:
    """Epoch milliseconds -> UTC timestamp."""
    return F.timestamp_millis(col(ms))


def mid_price(bid: str | Column = "bid_price", ask: str | Column = "ask_price") -> Column:
    """(bid + ask) div 2 when both sides are positive, else null."""
    b, a = col(bid), col(ask)
    return F.when((b > 0) & (a > 0), F.call_function("div", b + a, F.lit(2)))


def spread_bps(bid: str | Column = "bid_price", ask: str | Column = "ask_price") -> Column:
    """round-half-even(10000 * (ask - bid) / mid) as int; null without a mid."""
    b, a = col(bid), col(ask)
    m = mid_price(b, a)
    return F.when(m > 0, F.bround(F.lit(10000.0) * (a - b) / m, 0).cast("int"))


def l1_derived(df):
    """Add mid_price and spread_bps to an L1 frame.  Crossed books keep a negative spread."""
    return df.withColumn("mid_price", mid_price()).withColumn("spread_bps", spread_bps())


def action_factor(action_type: str | Column = "action_type", ratio: str | Column = "ratio",
                  amount: str | Column = "amount", close_prev: str | Column = "close_prev") -> Column:
    """Backward-adjustment factor of one corporate action (P10).

    split -> 1/r; stock dividend and rights -> 1/(1+r); cash dividend ->
    (prev - amount)/prev; anything else, or missing / non-positive inputs -> 1.
    """
    at, r, amt = col(action_type), col(ratio), col(amount)
    cp = col(close_prev).cast("double")
    one = F.lit(1.0)
    return (
        F.when(at == "split", F.when(r > 0, one / r).otherwise(one))
        .when(at.isin("dividend_stock", "rights"), F.when(r > 0, one / (one + r)).otherwise(one))
        .when(at == "dividend_cash",
              F.when(amt.isNull() | (amt == 0) | cp.isNull() | (cp <= 0), one)
              .otherwise((cp - amt) / cp))
        .otherwise(one)
    )


def bucket_symbol(symbol: str | Column, n: int, pinned: list[str] | None = None) -> Column:
    """Stable shard of a symbol in [0, n): the first 32 bits of its MD5; listed symbols
    are pinned to shard 0 (P18)."""
    s = col(symbol)
    b = (F.conv(F.substring(F.md5(s.cast("binary")), 1, 8), 16, 10).cast("long") % n).cast("int")
    if pinned:
        b = F.when(s.isin(*pinned), F.lit(0)).otherwise(b)
    return b


def bucket_skew(symbols, n: int):
    """Symbols per shard and their ratio to the mean (P18); n rows."""
    counts = symbols.groupBy(bucket_symbol("symbol", n).alias("bucket")).agg(F.count(F.lit(1)).alias("symbols"))
    total = F.sum("symbols").over(Window.partitionBy())  # n rows
    return counts.select("bucket", "symbols", (F.col("symbols") * float(n) / total).alias("of_mean"))
