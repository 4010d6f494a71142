"""Order-book queries: top of book (W1), book as-of (J5), ladder (P20), tape (T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from .asof import asof_measured

TOB_COLS = ["symbol", "asset_class", "exchange", "date", "last_ts", "bid_price", "bid_size",
            "ask_price", "ask_size", "mid_price", "spread_bps"]


def top_of_book(l1: DataFrame) -> DataFrame:
    """Newest L1 quote per (symbol, date); ties broken by arrival then book."""
    w = Window.partitionBy("symbol", "date").orderBy(
        F.col("ts_event").desc(), F.col("ts_received").desc(), F.col("bid_price").desc(),
        F.col("ask_price").desc())
    return (l1.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .withColumnRenamed("ts_event", "last_ts").select(*TOB_COLS))


def _levels(side: str, what: str):
    return F.array(*[F.col(f"{side}_{what}_{i}") for i in range(1, schemas.BOOK_LEVELS + 1)])


BOOK_ARRAYS = {"bid_px": ("bid", "px"), "bid_sz": ("bid", "sz"),
               "ask_px": ("ask", "px"), "ask_sz": ("ask", "sz")}


def l2_at(l2: DataFrame, probes: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Newest book at or before each probe's timestamp, same symbol and day.

    Adds bid_px, bid_sz, ask_px, ask_sz as 10-element arrays; empty arrays
    when the day has no earlier book.  The as-of runs per (symbol, date); a busy
    symbol-day is cut at quantiles of its own rows and spread over many tasks.
    """
    books = l2.select("symbol", "date", F.col("ts_event").alias("_bts"),
                      *[_levels(s, w).alias(f"_{k}") for k, (s, w) in BOOK_ARRAYS.items()],
                      F.lit(True).alias("_found"))
    p = probes.withColumn("_pdate", F.to_date(ts_col))
    books = books.withColumnRenamed("date", "_pdate")
    vals = [f"_{k}" for k in BOOK_ARRAYS] + ["_found"]
    j = asof_measured(p, books, by=["symbol", "_pdate"], left_key=ts_col, right_key="_bts", values=vals, strict=False)
    empty = F.array().cast("array<bigint>")
    out = j
    for k in BOOK_ARRAYS:
        out = out.withColumn(k, F.when(F.col("_found"), F.col(f"_{k}")).otherwise(empty))
    return out.drop(*vals, "_pdate")


def l2_ladder(l2: DataFrame, keys: list[str]) -> DataFrame:
    """Wide book row -> 10 rows: level, bid_sz, bid_px, ask_px, ask_sz."""
    parts = []
    for i in range(1, schemas.BOOK_LEVELS + 1):
        parts.append(F.struct(F.lit(i).alias("level"), F.col(f"bid_sz_{i}").alias("bid_sz"),
                              F.col(f"bid_px_{i}").alias("bid_px"), F.col(f"ask_px_{i}").alias("ask_px"),
                              F.col(f"ask_sz_{i}").alias("ask_sz")))
    return (l2.select(*keys, F.explode(F.array(*parts)).alias("_l"))
            .select(*keys, "_l.level", "_l.bid_sz", "_l.bid_px", "_l.ask_px", "_l.ask_sz"))


def tick_tape(ticks: DataFrame, n: int = 50) -> DataFrame:
    """Latest `n` ticks per (symbol, date), newest first (top-k per group)."""
    w = Window.partitionBy("symbol", "date").orderBy(F.col("ts_event").desc(), F.col("trade_id").desc())
    return ticks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
