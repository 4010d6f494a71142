"""Daily adjustment by what has changed (J4 + P10 + J6 for L2).

The factors of all actions are kept with the bar that each was computed from.  When bars or actions
change, only the factors that depend on them are found anew; a symbol's cumulative factors are suffix products of
its factors, so a changed factor moves the bars before its ex_date and no others.  Products are taken in the order of the
full run, so the adjusted closes are equal to its, bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prices import action_factor

KEY = ["symbol", "ex_date", "action_type"]
INPUTS = [*KEY, "ratio", "amount"]
FACTOR_COLS = [*INPUTS, "prev_date", "close_prev", "factor"]


def factors_from(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """FACTOR_COLS of every action: the last bar with a close strictly before its ex_date, and the factor."""
    b = bars.where(F.col("close").isNotNull()).select("symbol", F.col("date").alias("_k"), F.lit(1).alias("_side"), F.struct("date", "close").alias("_bar"))
    a = actions.select(*INPUTS, F.col("ex_date").alias("_k"), F.lit(0).alias("_side"))
    # a symbol's partition holds a row for each trading day and action
    before = Window.partitionBy("symbol").orderBy("_k", "_side").rowsBetween(Window.unboundedPreceding, 0)
    u = a.unionByName(b, allowMissingColumns=True).withColumn("_last", F.last("_bar", ignorenulls=True).over(before)).where("_side = 0")
    return u.select(*INPUTS, F.col("_last.date").alias("prev_date"), F.col("_last.close").alias("close_prev")).withColumn(
        "factor", action_factor())


def refreshed(actions: DataFrame, known: DataFrame, changed: DataFrame, bars: DataFrame) -> DataFrame:
    """The factors of `actions` after a change: those of `known` that still hold, and the others found anew.

    `changed` has the (symbol, date) of bars that are new, gone or different; `bars` is the table after the
    change, read for the symbols of outdated factors only.  A factor is outdated if its action is new or
    different, or if a bar has changed between the one it was computed from and its ex_date.
    """
    days = changed.groupBy("symbol").agg(F.collect_set("date").alias("_days"))
    old = known.select(*[F.col(c) for c in KEY], F.lit(True).alias("_known"), F.col("ratio").alias("_ratio"),
                       F.col("amount").alias("_amount"), "prev_date", "close_prev", "factor")
    j = actions.select(*INPUTS).join(old, KEY, "left").join(days, "symbol", "left")
    moved = F.exists(F.coalesce("_days", F.array().cast("array<date>")), lambda d: (d < F.col("ex_date")) & (
        F.col("prev_date").isNull() | (d >= F.col("prev_date"))))
    outdated = F.col("_known").isNull() | ~F.col("ratio").eqNullSafe(F.col("_ratio")) | ~F.col("amount").eqNullSafe(F.col("_amount")) | moved
    j = j.withColumn("_outdated", F.coalesce(outdated, F.lit(True)))
    again = j.where("_outdated").select(*INPUTS)
    theirs = bars.join(again.select("symbol").distinct(), "symbol", "left_semi")
    return j.where("not _outdated").select(*FACTOR_COLS).unionByName(factors_from(again, theirs).select(*FACTOR_COLS))


def moved_symbols(before: DataFrame, after: DataFrame) -> DataFrame:
    """(symbol, until): symbols whose factors differ, and the date before which their bars have to be adjusted anew."""
    b, a = (x.select(*KEY, F.col("factor").alias(n)) for x, n in ((before, "_b"), (after, "_a")))
    both = b.join(a, KEY, "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).groupBy("symbol").agg(F.max("ex_date").alias("until"))


def suffix_products(factors: DataFrame) -> DataFrame:
    """(symbol, later): for each action, ascending by (ex_date, action_type), the product of its and all later factors,
    multiplied in that order."""
    per = factors.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("ex_date", "action_type", "factor"))).alias("a"))
    product = F.transform("a", lambda x, i: F.struct(x["ex_date"].alias("ex_date"), F.aggregate(
        F.slice("a", i + 1, F.size("a") - i), F.lit(1.0), lambda acc, y: acc * y["factor"]).alias("product")))
    return per.select("symbol", product.alias("later"))


def adjusted_close(later: str = "later") -> Column:
    """trunc(close * product of the factors with ex_date > date)."""
    next_ = F.get(F.filter(F.col(later), lambda x: (x["ex_date"] > F.col("date")) & x["product"].isNotNull()), F.lit(0))
    return (F.coalesce(next_["product"], F.lit(1.0)) * F.col("close")).cast("long")


def readjusted(rows: DataFrame, factors: DataFrame, again: Column) -> DataFrame:
    """`rows` (symbol, date, close, adj_close, ...) with the adjusted close found anew where `again` holds.

    Bars and the products of their symbol meet in one window over (symbol, date), where a bar takes the next product after
    it, so its cost does not grow with the number of actions.  A factor of 1 changes no product and needs no row.
    """
    some = factors.where(F.col("symbol").isNotNull() & F.col("ex_date").isNotNull() & ~F.col("factor").eqNullSafe(F.lit(1.0)))
    later = suffix_products(some).select("symbol", F.posexplode("later").alias("_i", "_p")).select(
        "symbol", F.col("_p.ex_date").alias("_k"), F.lit(0).alias("_side"), "_i", F.col("_p.product").alias("_product"))
    # actions sort before bars at equal dates: an action does not adjust the bar of its own ex_date
    u = rows.withColumns({"_again": again, "_k": F.col("date"), "_side": F.lit(1)}).unionByName(later, allowMissingColumns=True)
    u = u.withColumn("_next", F.expr("lead(_product, 1) IGNORE NULLS OVER (PARTITION BY symbol ORDER BY _k, _side, _i)")).where("_side = 1")
    product = F.coalesce(F.when(F.col("symbol").isNotNull() & F.col("date").isNotNull(), F.col("_next")), F.lit(1.0))
    return u.withColumn("adj_close", F.when(F.col("_again"), (product * F.col("close")).cast("long")).otherwise(F.col("adj_close"))).select(*rows.columns)
