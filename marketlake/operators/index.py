"""M9: an index recomputed from its constituents, chained by a divisor.

A day's move is that of the basket of constituents which have a bar today, an earlier bar and a weight known by then;
each counts with its weight.  Chaining the moves, a running product over days, makes entries, exits and new weights leave the level
as it is, as a divisor adjusted each day would.  Sums are of whole numbers, so the level does not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_measured

#: Parts of a weight that a constituent's move is cut to.
PARTS = 1_000_000


def basket_moves(bars: DataFrame, weights: DataFrame, group: DataFrame | None = None) -> DataFrame:
    """(index_code, date, constituents, ratio): the weighted move of each day's basket.

    `bars` (symbol, date, close), `weights` (symbol, as_of_date, weight long; the last known before a bar holds, the larger
    of two of one day), `group` (symbol, index_code); without it there is one index, ALL.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    b = bars.select("symbol", "date", "close").where("close > 0").withColumn("_prev", F.lag("close").over(w)).where("_prev is not null")
    known = weights.where("weight > 0 and as_of_date is not null").select("symbol", "as_of_date", "weight")
    b = asof_measured(b, known, ["symbol"], "date", "as_of_date", ["weight"], strict=True, right_order=["weight"]).where("weight is not null")
    b = b.join(group.select("symbol", "index_code"), "symbol") if group is not None else b.withColumn("index_code", F.lit("ALL"))
    part = F.expr(f"cast(cast(weight as decimal(38,0)) * close * {PARTS} div _prev as decimal(38,0))")
    return b.groupBy("index_code", "date").agg(
        F.count(F.lit(1)).alias("constituents"), F.sum(part).alias("_up"), F.sum(F.col("weight").cast("decimal(38,0)") * PARTS).alias("_of")).select(
        "index_code", "date", "constituents", (F.col("_up").cast("double") / F.col("_of").cast("double")).alias("ratio"))


def index_recompute(bars: DataFrame, weights: DataFrame, published: DataFrame, group: DataFrame | None = None, tolerance: float = 0.001) -> DataFrame:
    """(index_code, date, constituents, level, published, rel_diff, off) of every day with a move.

    The level starts from the published value (index_code, date, value) of the first day that has one, or 1000 on the
    day of the first move; `off` marks published days that differ by more than `tolerance`.
    One index has a row a day, so its running product is bounded by the calendar.
    """
    moves = basket_moves(bars, weights, group)
    run = Window.partitionBy("index_code").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("index_code").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chained = moves.withColumn("_chain", F.product("ratio").over(run)).join(
        published.select("index_code", "date", F.col("value").alias("published")), ["index_code", "date"], "left")
    # value and chain of the day that the level is based on
    base = F.first(F.when(F.col("published").isNotNull(), F.struct("published", "_chain")), ignorenulls=True).over(whole)
    first = F.first("_chain").over(whole)
    d = chained.withColumns({"_base": base, "_first": first})
    level = F.coalesce(F.col("_chain") * (F.col("_base.published") / F.col("_base._chain")), F.col("_chain") * (F.lit(1000.0) / F.col("_first")))
    d = d.withColumn("level", level).withColumn("rel_diff", F.abs(F.col("published") - F.col("level")) / F.col("level"))
    return d.select("index_code", "date", "constituents", "level", "published", "rel_diff", (F.col("rel_diff") > tolerance).alias("off"))
