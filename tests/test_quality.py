"""The corrected check of applied actions on rows of its own."""

import datetime as dt

from marketlake.operators import quality

D = dt.date


def frames(spark):
    daily = spark.createDataFrame(
        [("A", D(2023, 12, 28), 100, 100), ("A", D(2024, 1, 5), 90, 90), ("B", D(2024, 1, 2), 50, 25), ("B", D(2024, 1, 3), 60, 60),
         (None, D(2024, 1, 2), 70, 70), ("C", None, 80, 80)], "symbol string, date date, close long, adj_close long")
    factors = spark.createDataFrame(
        [("A", D(2024, 1, 4), "split", 0.5), ("A", D(2024, 1, 6), "merger", 0.5), ("A", D(2024, 1, 6), "dividend_cash", 1.0),
         ("A", D(2023, 12, 28), "split", 0.5), ("B", D(2024, 1, 3), "split", 0.5), (None, D(2024, 1, 4), "split", 0.5),
         ("C", D(2024, 1, 4), "split", 0.5), ("A", None, "split", 0.5)], "symbol string, ex_date date, action_type string, factor double")
    return daily, factors


def test_corp_actions_applied_fixed(spark):
    """The last bar before an effective action, in an earlier year too, is flagged if it is not adjusted."""
    daily, factors = frames(spark)
    got = [tuple(r) for r in quality.corp_actions_applied_fixed(daily, factors, days=None).collect()]
    assert got == [("A", D(2024, 1, 4), "split", D(2023, 12, 28))]


def test_summary_counts_the_corrected_check(spark):
    daily, factors = frames(spark)
    got = quality.dq_summary({"fixed": lambda: quality.corp_actions_applied_fixed(daily, factors, days=None)}).collect()
    assert [tuple(r) for r in got] == [("fixed", 1, True)]
