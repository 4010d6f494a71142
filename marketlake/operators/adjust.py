"""Backward price adjustment from corporate actions (J4 -> P10 -> J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prices import action_factor


def _bars_and_actions(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Bars and actions of a symbol in one frame, keyed by date; actions sort
    before bars at equal dates (side 0 vs 1)."""
    b = bars.withColumn("_k", F.col("date")).withColumn("_side", F.lit(1))
    a = actions.withColumn("_k", F.col("ex_date")).withColumn("_side", F.lit(0))
    return b.unionByName(a, allowMissingColumns=True)


def _with_prev_close(u: DataFrame) -> DataFrame:
    """Action rows get close_prev: the last bar close strictly before ex_date.

    A symbol's partition holds one bar per trading day plus its actions, so
    partitioning by symbol is bounded by the calendar, not by data volume."""
    asc = Window.partitionBy("symbol").orderBy("_k", "_side").rowsBetween(Window.unboundedPreceding, 0)
    is_action = F.col("_side") == 0
    prev = F.last(F.when(~is_action, F.col("close")), ignorenulls=True).over(asc)
    return u.withColumn("close_prev", F.when(is_action, prev))


def asof_prev_close(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """Each action with the last close strictly before its ex_date."""
    u = _with_prev_close(_bars_and_actions(bars.select("symbol", "date", "close"), actions))
    return u.where(F.col("_side") == 0).select(*actions.columns, "close_prev")


def action_factors(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """symbol, ex_date, action_type, ratio, amount, close_prev, factor per action (P10)."""
    with_prev = asof_prev_close(actions, bars)
    return with_prev.select("symbol", "ex_date", "action_type", "ratio", "amount", "close_prev",
                            action_factor().alias("factor"))


def adjust_prices(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """adj_close = trunc(close * product of factors with ex_date > date) (J4 + P10 + J6).

    One union of bars and actions, shuffled and sorted by symbol and descending date once (bars sort before actions at
    equal dates, so an action never adjusts its own ex-date bar).  An action's factor comes from the next close after it in
    that order; the factors met so far, folded in ascending (ex_date, action_type) order -- the same order everywhere, so the
    truncated result is bit-stable -- are its product, and a bar takes the product of the last action met.  All steps
    share the one sort, lists hold plain numbers and live for a row, and no row is multiplied by the number of actions.
    """
    acts = actions.select("symbol", "ex_date", "action_type", "ratio", "amount")
    u = _bars_and_actions(bars, acts)
    is_action = F.col("_side") == 0
    # ratio and amount order actions of one key, which curated ones do not share
    down = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in ("_k", "_side", "action_type")], "ratio", "amount")
    met = down.rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumn("_close", F.when(~is_action, F.col("close")))
    u = u.withColumn("close_prev", F.expr(
        "lead(_close, 1) IGNORE NULLS OVER (PARTITION BY symbol ORDER BY _k DESC, _side DESC, action_type DESC, ratio, amount)"))
    # a factor of 1 changes no product
    factor = action_factor()
    u = u.withColumn("_f", F.when(is_action & (factor != 1.0), factor))
    u = u.withColumn("_later", F.collect_list("_f").over(met))
    fold = F.aggregate(F.reverse("_later"), F.lit(1.0), lambda acc, x: acc * x)
    u = u.withColumn("_cum", F.when(is_action, fold))
    cum = F.coalesce(F.last("_cum", ignorenulls=True).over(met), F.lit(1.0))
    out = u.withColumn("adj_close", F.when(~is_action, (cum * F.col("close")).cast("long")))
    return out.where(~is_action).select(*bars.columns, "adj_close")
