"""M9 index recompute, M6 merged gaps per symbol, X8 sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import analytics, index, quality


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def bars(spark, closes):
    """{symbol: {day: close}}"""
    return spark.createDataFrame([(s, day(n), c) for s, by in closes.items() for n, c in by.items()], "symbol string, date date, close long")


def weights(spark, rows):
    return spark.createDataFrame([(s, day(n), w) for s, n, w in rows], "symbol string, as_of_date date, weight long")


NONE = "index_code string, date date, value double"


def test_index_follows_its_basket(spark):
    b = bars(spark, {"A": {0: 100, 1: 110, 2: 121}, "B": {0: 200, 1: 200, 2: 100}})
    w = weights(spark, [("A", -5, 300), ("B", -5, 100)])
    got = {r.date: r for r in index.index_recompute(b, w, spark.createDataFrame([], NONE)).collect()}
    up1, up2 = (300 * 1.1 + 100 * 1.0) / 400, (300 * 1.1 + 100 * 0.5) / 400
    assert set(got) == {day(1), day(2)} and got[day(1)].level == pytest.approx(1000)
    assert got[day(2)].level == pytest.approx(1000 * up2, rel=1e-6) and got[day(1)].published is None and got[day(1)].off is None
    moves = {r.date: r.ratio for r in index.basket_moves(b, w).collect()}
    assert moves[day(1)] == pytest.approx(up1, rel=1e-6) and moves[day(2)] == pytest.approx(up2, rel=1e-6)


def test_entries_exits_and_new_weights_leave_the_level(spark):
    flat = {n: 100 for n in range(10)}
    b = bars(spark, {"A": flat, "B": {n: 7 for n in range(3, 6)}, "C": {n: 100 + n for n in range(8, 10)}})
    w = weights(spark, [("A", -1, 10), ("A", 4, 10**12), ("B", 0, 10**9), ("D", 0, 5)])
    levels = [r.level for r in index.index_recompute(b, w, spark.createDataFrame([], NONE)).orderBy("date").collect()]
    assert len(levels) == 9 and levels == pytest.approx([1000] * 9)


def test_published_values_beyond_the_tolerance_are_marked(spark):
    b = bars(spark, {"A": {0: 1000, 1: 1010, 2: 1020, 3: 1030}})
    w = weights(spark, [("A", -1, 1)])
    pub = spark.createDataFrame([("ALL", day(1), 50.5), ("ALL", day(2), 51.0), ("ALL", day(3), 51.6)], NONE)
    got = {r.date: (round(r.level, 3), r.off) for r in index.index_recompute(b, w, pub).collect()}
    assert got == {day(1): (50.5, False), day(2): (51.0, False), day(3): (51.5, True)}


def test_a_weight_holds_from_the_day_after_it_is_known(spark):
    b = bars(spark, {"A": {0: 100, 1: 200, 2: 200}, "B": {0: 100, 1: 100, 2: 100}})
    w = weights(spark, [("A", 1, 1), ("B", -1, 1), ("B", 1, None), ("A", 1, 3)])
    m = {r.date: (r.constituents, r.ratio) for r in index.basket_moves(b, w).collect()}
    assert m == {day(1): (1, 1.0), day(2): (2, 1.0)}


def gaps(spark, *rows):
    return spark.createDataFrame([(s, a, b, r) for s, a, b, r in rows], "stream string, start date, end date, reason string")


def test_gaps_are_merged_by_a_sweep(spark):
    g = gaps(spark, ("ticks", day(0), day(3), "x"), ("ticks", day(2), day(5), "y"), ("ticks", day(6), None, None), ("ticks", day(8), day(9), "x"),
             ("ticks", day(8), day(8), "x"), ("ticks", day(30), day(20), "bad"), ("ticks", None, day(2), "bad"), ("l1", day(0), day(99), "other"),
             ("ticks", day(0), day(1), "x"))
    got = sorted(map(tuple, analytics.merged_gaps(g, "ticks").collect()))
    assert got == [(day(0), day(6), "; x; y"), (day(8), day(9), "x")]


def test_gap_days_stand_within_each_symbols_span(spark):
    ticks = spark.createDataFrame([("A", day(0)), ("A", day(2)), ("A", day(2)), ("A", day(9)), ("B", day(4))], "symbol string, date date")
    g = gaps(spark, ("ticks", day(1), day(3), "x"), ("ticks", day(3), day(5), "x"), ("ticks", day(8), day(40), "z"))
    got = sorted((r.symbol, r.date, r.ticks, r.reasons) for r in analytics.gap_filled_by_symbol(ticks, g).collect())
    want = [("A", day(0), 1, None), ("A", day(1), None, "x"), ("A", day(2), 2, "x"), ("A", day(3), None, "x"), ("A", day(4), None, "x"),
            ("A", day(5), None, "x"), ("A", day(8), None, "z"), ("A", day(9), 1, "z"), ("B", day(4), 1, "x")]
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]
    assert analytics.gap_filled_by_symbol(ticks.limit(0), g).count() == 0


def test_sketches_merge_within_their_rank_error(spark):
    """A week's quantile from the sketches of its days, against the exact ranks of 400,000 skewed lags."""
    n = 400_000
    lag = (F.pow(F.rand(5) * 1000, F.lit(2.0))).cast("long")
    df = spark.range(n).select(F.timestamp_micros(F.col("id") * 1_400_000 + 1_704_067_200_000_000).alias("ts_event"), lag.alias("_l")).select(
        "ts_event", F.timestamp_micros(F.unix_micros("ts_event") + F.col("_l")).alias("ts_received"), "_l").persist()
    s = quality.lag_sketches({"ticks": df})
    for rank in (0.5, 0.99):
        r = quality.lag_quantiles(s, ["stream"], rank).first()
        below, upto = df.agg(F.avg((F.col("_l") < r.lag_us).cast("int")), F.avg((F.col("_l") <= r.lag_us).cast("int"))).first()
        assert r.messages == n and below <= rank + quality.SKETCH_ERROR and upto >= rank - quality.SKETCH_ERROR
    assert quality.lag_rank_check({"ticks": df}).where("not within").count() == 0
    df.unpersist()
