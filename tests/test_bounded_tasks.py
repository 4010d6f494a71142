"""What one task sorts or holds does not grow with a table."""

import datetime as dt

from __spark_entry__ import queries
from marketlake import bindings
from marketlake.operators import asof, incremental
from marketlake.operators.adjust import adjust_prices
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_adjustment_sorts_once(spark):
    bars = spark.createDataFrame([("A", D(2024, 1, 1), 100)], "symbol string, date date, close long")
    acts = spark.createDataFrame([("A", D(2024, 1, 2), "split", 2.0, None)], "symbol string, ex_date date, action_type string, ratio double, amount double")
    p = plan(adjust_prices(bars, acts))
    assert p.count("Sort [") == 1 and p.count("Exchange") == 1


def test_adjustment_orders_actions_of_a_day_and_skips_factors_of_one(spark):
    bars = spark.createDataFrame([("A", D(2024, 1, d), c) for d, c in ((1, 1000), (2, None), (4, 700), (6, 900))], "symbol string, date date, close long")
    acts = spark.createDataFrame(
        [("A", D(2024, 1, 4), "split", 3.0, None), ("A", D(2024, 1, 4), "rights", 0.3, None), ("A", D(2024, 1, 5), "merger", 9.0, None),
         ("A", D(2024, 1, 6), "dividend_cash", None, 7.0), ("A", None, "split", 2.0, None)],
        "symbol string, ex_date date, action_type string, ratio double, amount double")
    cash = (700.0 - 7.0) / 700.0
    first = 1.0 * (1.0 / 1.3) * (1.0 / 3.0) * cash
    got = {r.date.day: r.adj_close for r in adjust_prices(bars, acts).collect()}
    assert got == {1: int(first * 1000), 2: None, 4: int(cash * 700), 6: 900}


def test_ranges_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(asof, "MOST_ROWS", 1000)
    left = spark.range(8000).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    out = asof.asof_measured(left, left.select("k", F.col("t").alias("p")), ["k"], "t", "p", ["p"], strict=False, least_rows=10)
    assert out.rdd.getNumPartitions() == 16
    assert out.where("t = p").count() == 8000


def test_wide_books_are_dealt_by_the_number_of_events(spark, monkeypatch):
    monkeypatch.setattr(bindings, "ROWS_PER_TASK", 50)
    lake = bindings.TestLake(spark, SF_SMALL)
    n = lake.table("events").count()
    assert lake._events_dealt.rdd.getNumPartitions() == -(-n // 50)
    assert lake.quotes_l2_raw.count() == lake.quotes_l1_raw.count()


def test_readjusted(spark):
    rows = spark.createDataFrame(
        [("A", D(2024, 1, 1), 100, 1, True), ("A", D(2024, 1, 2), 100, 2, True), ("A", D(2024, 1, 3), 100, 3, False), ("A", D(2024, 1, 9), 100, 4, True),
         (None, D(2024, 1, 1), 100, 5, True), ("A", None, 100, 6, True)], "symbol string, date date, close long, adj_close long, again boolean")
    factors = spark.createDataFrame(
        [("A", D(2024, 1, 2), "split", 0.5), ("A", D(2024, 1, 4), "rights", 0.8), ("A", D(2024, 1, 4), "merger", 1.0), (None, D(2024, 1, 4), "split", 0.5)],
        "symbol string, ex_date date, action_type string, factor double")
    out = incremental.readjusted(rows, factors, F.col("again"))
    assert out.columns == rows.columns
    assert sorted((r.adj_close for r in out.collect())) == sorted([40, 80, 3, 100, 100, 100])


def test_bpe_steps_do_not_share_a_stage(spark):
    assert plan(queries()["op13_bpe"](spark, SF_SMALL)).count("MapInArrow") == 1
