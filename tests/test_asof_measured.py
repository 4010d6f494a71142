"""As-of joins over measured ranges: equal to a plain search, and evenly dealt where one key is busy."""

import datetime as dt
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from marketlake.operators.asof import _Ranges, asof_measured

T0 = dt.datetime(2024, 1, 5, 9)


def frames(spark, seed, hot=0.5, n=1500):
    r = random.Random(seed)

    def rows(n):
        for i in range(n):
            key = "hot" if r.random() < hot else r.choice([None, "a", "b", "c"])
            at = None if r.random() < 0.02 else T0 + dt.timedelta(seconds=r.randrange(3600) if key == "hot" else r.randrange(90_000))
            yield key, at, i
    left, right = list(rows(n)), list(rows(n))
    return left, right, spark.createDataFrame(left, "k string, t timestamp, i int"), spark.createDataFrame(right, "k string, rt timestamp, v int")


def plain(left, right, strict, forward):
    out = []
    for k, t, i in left:
        near = None
        for rk, rt, v in right:
            if rk != k or t is None or rt is None:
                continue
            ok = (rt > t if strict else rt >= t) if forward else (rt < t if strict else rt <= t)
            if ok and (near is None or ((rt, v) < near if forward else (rt, v) > near)):
                near = (rt, v)
        out.append((i, near and near[1]))
    return sorted(out)


@pytest.mark.parametrize("strict,forward,rows", [(True, False, 20), (False, False, 20), (True, True, 20), (False, True, 20), (False, False, 7), (False, False, None)])
def test_equals_a_plain_search(spark, strict, forward, rows):
    left, right, lf, rf = frames(spark, 3)
    got = asof_measured(lf, rf, ["k"], "t", "rt", ["v"], strict=strict, forward=forward, right_order=["v"], rows_per_range=rows)
    assert got.columns == ["k", "t", "i", "v"]
    assert sorted((r.i, r.v) for r in got.collect()) == plain(left, right, strict, forward)


def test_ranges_without_right_rows_take_the_carry(spark):
    left = [("x", T0 + dt.timedelta(seconds=s), s) for s in range(500)]
    right = [("x", T0 + dt.timedelta(seconds=s), s) for s in (3, 490)]
    got = asof_measured(spark.createDataFrame(left, "k string, t timestamp, i int"), spark.createDataFrame(right, "k string, rt timestamp, v int"),
                        ["k"], "t", "rt", ["v"], strict=False, rows_per_range=10)
    assert sorted((r.i, r.v) for r in got.collect()) == [(s, None if s < 3 else 3 if s < 490 else 490) for s in range(500)]


def test_empty_sides(spark):
    _, _, lf, rf = frames(spark, 1, n=50)
    assert asof_measured(lf.limit(0), rf, ["k"], "t", "rt", ["v"], strict=True, rows_per_range=5).count() == 0
    assert asof_measured(lf, rf.limit(0), ["k"], "t", "rt", ["v"], strict=True, rows_per_range=5).where("v is null").count() == 50


def test_a_busy_hour_is_dealt_evenly(spark):
    """One symbol-hour holds a third of the rows; no task reads twice what the median task does."""
    tasks = 16
    keep = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 60_000
        hot = spark.range(n // 3).select(F.lit("HOT").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=(F.col("id") % 3600).cast("decimal(18,6)"))).alias("t"))
        rest = spark.range(2 * n // 3).select(F.concat(F.lit("s"), F.col("id") % 700).alias("k"), (F.lit(T0) + F.make_dt_interval(
            secs=(F.col("id") % 20_000).cast("decimal(18,6)"))).alias("t"))
        df = hot.unionByName(rest)
        out = asof_measured(df, df.select("k", F.col("t").alias("p")), ["k"], "t", "p", ["p"], strict=True, least_rows=1)
        # the greatest match is asked for too, so that the as-of pass is not optimised away
        per_task = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("p")).collect()]
        assert sum(per_task) == n and len(per_task) == tasks
        assert max(per_task) <= 2 * median(per_task)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)


def test_only_hot_keys_get_splitters(spark):
    df = spark.createDataFrame([("hot", i) for i in range(1000)] + [(f"k{i}", i) for i in range(500)], "k string, _k int")
    ranges = _Ranges(df, ["k"], 100, 1)
    assert [r["_h0"] for r in ranges.frame.collect()] == ["hot"]
    numbered = ranges.number(df)
    n = {r["_b"]: r["count"] for r in numbered.where("k = 'hot'").groupBy("_b").count().collect()}
    assert len(n) == 10 and max(n.values()) <= 130 and numbered.where("k <> 'hot' and _b <> 0").count() == 0
    order = [r["_b"] for r in numbered.where("k = 'hot'").orderBy("_k").collect()]
    assert order == sorted(order)
