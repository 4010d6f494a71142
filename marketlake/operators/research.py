"""Research queries over daily bars: stats, rankings, movers, KPIs, equity curves.

Every aggregate is a hash aggregate keyed by symbol (or strategy) with map-side
partial aggregation; rankings are `orderBy(...).limit(n)` which Spark plans as
TakeOrderedAndProject (per-task top-n, then a merge of n rows per task).
`as_of` is always a parameter (default: newest date in the data), never the
wall clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from .factors import drawdown, returns


def _d(x) -> Column:
    return F.lit(str(x)).cast("date")


def resolve_as_of(daily: DataFrame, as_of=None) -> dt.date:
    if as_of is not None:
        return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return daily.agg(F.max("date")).first()[0]


def lake_stats(daily: DataFrame) -> DataFrame:
    """Row count, distinct symbols, first and last date."""
    return daily.agg(F.count(F.lit(1)).alias("row_count"),
                     F.count_distinct("symbol").alias("symbol_count"),
                     F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def top_k(df: DataFrame, col: str, n: int, descending: bool = True, tie: str = "symbol") -> DataFrame:
    c = F.col(col).desc() if descending else F.col(col).asc()
    return df.orderBy(c, F.col(tie).asc()).limit(n)


def top_volume(daily: DataFrame, as_of=None, days: int = 30, n: int = 25) -> DataFrame:
    """Average volume and day count over the trailing window, top n."""
    a = resolve_as_of(daily, as_of)
    agg = (daily.where(F.col("date") >= _d(a - dt.timedelta(days=days)))
           .groupBy("symbol").agg(F.avg("volume").alias("avg_volume"), F.count(F.lit(1)).alias("days")))
    return top_k(agg, "avg_volume", n)


def coverage_by_symbol(daily: DataFrame) -> DataFrame:
    """Days, first and last date per symbol, most covered first."""
    return (daily.groupBy("symbol").agg(F.count(F.lit(1)).alias("days"),
                                        F.min("date").alias("first_date"),
                                        F.max("date").alias("last_date"))
            .orderBy(F.col("days").desc(), "symbol"))


def best_performers(daily: DataFrame, since=None, n: int = 25) -> DataFrame:
    """First and last close since a date (default: start of the as-of year); top n % change."""
    if since is None:
        since = dt.date(resolve_as_of(daily).year, 1, 1)
    opening, latest = F.min_by("close", "date"), F.max_by("close", "date")
    change = F.try_divide(latest - opening, F.when(opening > 0, opening)) * 100
    year = daily.where(F.col("date") >= _d(since)).groupBy("symbol").agg(change.alias("ytd_pct"))
    return top_k(year.where(F.col("ytd_pct").isNotNull()), "ytd_pct", n)


def range_drawdown(daily: DataFrame, as_of=None, days: int = 365, n: int = 25) -> DataFrame:
    """(low - high) / high over the trailing window, worst n (G7; order-blind)."""
    a = resolve_as_of(daily, as_of)
    window = daily.where(F.col("date") >= _d(a - dt.timedelta(days=days)))
    spread = window.groupBy("symbol").agg(F.max("close").alias("hi"), F.min("close").alias("lo")).select(
        "symbol", "hi", "lo", (F.try_divide(F.col("lo") - F.col("hi"), F.when(F.col("hi") > 0, F.col("hi"))) * 100).alias("dd_pct"))
    return top_k(spread.where(F.col("dd_pct").isNotNull()), "dd_pct", n, descending=False)


def movers(daily: DataFrame, as_of=None, interval_days: int | None = 30, min_vol: float = 0) -> DataFrame:
    """First and last bar per symbol inside the window; % change.

    `interval_days=None` means year to date.
    """
    a = resolve_as_of(daily, as_of)
    ref = dt.date(a.year, 1, 1) if interval_days is None else a - dt.timedelta(days=interval_days)
    row = F.struct("date", "close", "volume")
    b = (daily.where(F.col("date").between(_d(ref), _d(a))).groupBy("symbol")
         .agg(F.max_by(row, "date").alias("last_row"), F.min_by(row, "date").alias("first_row"),
              F.avg("volume").alias("avg_vol")))
    return (b.where((F.col("avg_vol") >= min_vol) & (F.col("first_row.close") > 0))
            .select("symbol", F.col("last_row.date").alias("last_date"),
                    F.col("last_row.close").alias("last_close"),
                    F.col("first_row.close").alias("ref_close"),
                    F.col("last_row.volume").alias("last_volume"), "avg_vol",
                    (F.try_divide(F.col("last_row.close") - F.col("first_row.close"),
                                  F.nullif(F.col("first_row.close"), F.lit(0))) * 100).alias("pct_change")))


def breadth(mv: DataFrame) -> DataFrame:
    """Symbols, gainers, losers and latest date of a movers frame."""
    return mv.agg(F.count(F.lit(1)).alias("symbols"),
                  F.count_if(F.col("pct_change") > 0).alias("gainers"),
                  F.count_if(F.col("pct_change") < 0).alias("losers"),
                  F.max("last_date").alias("latest_date"))


def _sharpe(ret: Column, need_two: bool) -> Column:
    sd = F.stddev_samp(ret)
    ok = sd > 0
    if need_two:
        ok = ok & (F.count(ret) > 1)
    return F.when(ok, F.avg(ret) / sd * F.sqrt(F.lit(float(schemas.TRADING_DAYS_PER_YEAR)))).otherwise(F.lit(0.0))


def symbol_kpis(daily: DataFrame, digits: int = 9) -> DataFrame:
    """Per symbol: last close, period %, max drawdown %, Sharpe (252, sample std,
    0 when undefined), average volume (G10).  Std-based columns are rounded
    to `digits` decimals: their last bits depend on summation order."""
    s = drawdown(returns(daily, "symbol", "close"), "symbol", "close")
    first = F.min_by("close", "date")
    last = F.max_by("close", "date")
    return s.groupBy("symbol").agg(
        last.alias("last"),
        (F.try_divide(last - first, first) * 100).alias("period_pct"),
        (F.min("drawdown") * 100).alias("max_dd_pct"),
        F.round(_sharpe(F.col("ret"), True), digits).alias("sharpe"),
        F.avg("volume").alias("avg_volume"))


def symbol_summary(daily: DataFrame) -> DataFrame:
    """Last close, change %, period high and low, average volume."""
    first = F.min_by("close", "date")
    last = F.max_by("close", "date")
    return daily.groupBy("symbol").agg(
        last.alias("last_close"), (F.try_divide(last - first, first) * 100).alias("change_pct"),
        F.max("high").alias("period_high"), F.min("low").alias("period_low"),
        F.avg("volume").alias("avg_volume"))


def equity_stats(curve: DataFrame, key: str = "strategy", digits: int = 9) -> DataFrame:
    """Total return, CAGR, max drawdown, Sharpe per equity curve."""
    s = drawdown(returns(curve, key, "equity"), key, "equity")
    first = F.min_by("equity", "date")
    last = F.max_by("equity", "date")
    g = s.groupBy(key).agg(
        (F.try_divide(last, first) - 1).alias("total_return"),
        F.min("drawdown").alias("max_drawdown"),
        F.round(_sharpe(F.col("ret"), False), digits).alias("sharpe"),
        F.greatest(F.datediff(F.max("date"), F.min("date")), F.lit(1)).alias("_days"))
    cagr = F.pow(1 + F.col("total_return"), F.lit(365.0) / F.col("_days")) - 1
    return g.select(key, "total_return", F.round(cagr, digits).alias("cagr"), "max_drawdown", "sharpe")


def indexed(daily: DataFrame) -> DataFrame:
    """Every symbol's close rebased to 100 at its first date (W5, long form)."""
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding,
                                                                 Window.unboundedFollowing)
    return daily.select("symbol", "date", "close",
                        (F.try_divide(F.col("close"), F.first("close", ignorenulls=True).over(w)) * 100).alias("indexed"))


def recent_bars(daily: DataFrame, n: int = 250) -> DataFrame:
    """Newest n bars of every symbol (T5; top-k per group)."""
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return (daily.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
            .select("date", "symbol", "open", "high", "low", "close", "volume"))


def symbol_matrix(daily: DataFrame, symbols: list[str], value: str = "close") -> DataFrame:
    """date x symbol table of mean `value` (U3); the symbols are given, as a page's selection is."""
    return pivot_mean(daily.where(F.col("symbol").isin(symbols)), "date", "symbol", symbols, value)


def pivot_mean(df: DataFrame, index: str, column: str, values: list[str], value: str) -> DataFrame:
    """Wide table index x values of mean(value) (U3); values are given, never collected."""
    return df.groupBy(index).pivot(column, values).agg(F.avg(value))


def unpivot_mean(wide: DataFrame, index: str, values: list[str], name: str, value: str) -> DataFrame:
    """Melt a pivot back to long form, dropping empty cells."""
    return (wide.unpivot(index, values, name, value).where(F.col(value).isNotNull()))
