"""Per-series windows: returns, drawdown, indexed series.

All windows are partitioned by the series key (symbol or strategy) and
ordered by date.  A daily series holds one row per trading day, so a
partition is bounded by calendar length (~250 rows a year) no matter how
much intraday data a symbol has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ret(cur: Column, prev: Column) -> Column:
    return F.try_divide(cur - prev, F.nullif(prev, F.lit(0)))


def daily_factors(daily: DataFrame) -> DataFrame:
    """Raw and adjusted simple daily returns per symbol."""
    w = Window.partitionBy("symbol").orderBy("date")
    return daily.select(
        "date", "symbol", "asset_class", "exchange", "close", "adj_close", "volume", "value",
        _ret(F.col("close"), F.lag("close").over(w)).alias("daily_return"),
        _ret(F.col("adj_close"), F.lag("adj_close").over(w)).alias("adj_daily_return"),
    )


def factors_between(daily: DataFrame, start: str, end: str) -> DataFrame:
    """Factor rows in [start, end].  The filter is applied above the window so
    the first day in range still sees its previous close."""
    return daily_factors(daily).where(F.col("date").between(F.lit(start).cast("date"),
                                                            F.lit(end).cast("date")))


def returns(df: DataFrame, key: str, value: str, order: str = "date") -> DataFrame:
    """pct_change of `value` per `key` (W3); first row null."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("ret", _ret(F.col(value).cast("double"), F.lag(value).over(w).cast("double")))


def drawdown(df: DataFrame, key: str, value: str, order: str = "date") -> DataFrame:
    """Running peak and (value - peak) / peak per `key`."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    peak = F.max(value).over(w)
    return (df.withColumn("peak", peak)
              .withColumn("drawdown", F.try_divide(F.col(value) - F.col("peak"),
                                                   F.col("peak").cast("double"))))


def indexed_returns(df: DataFrame, key: str = "symbol", value: str = "close",
                    order: str = "date") -> DataFrame:
    """Each series rebased to 100 at its first non-null value."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                           Window.unboundedFollowing)
    first = F.first(value, ignorenulls=True).over(w)
    return df.withColumn("indexed", F.col(value) / first * 100)
