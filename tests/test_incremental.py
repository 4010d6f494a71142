"""Curation of daily bars by what has changed: equal to the full run, and only the years concerned are rewritten."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators import curate, incremental
from marketlake.plans import daily, jobs
from marketlake.sinks import lake as sink
from marketlake.sources import lake as src

COLS = [*curate.DAILY_COLS, "adj_close"]
TYPES = ("split", "dividend_cash", "dividend_stock", "rights", "merger")


def bars(spark, rows):
    """Bars of (date, symbol, close)."""
    df = spark.createDataFrame([(d, s, c) for d, s, c in rows], "date date, symbol string, close long")
    return df.select("date", "symbol", F.lit("equity").alias("asset_class"), F.lit("HOSE").alias("exchange"), F.col("close").alias("open"),
                     F.col("close").alias("high"), F.col("close").alias("low"), "close", F.lit(100).cast("long").alias("volume"),
                     (F.col("close") * 100).alias("value"), F.lit(None).cast("long").alias("foreign_buy_vol"),
                     F.lit(None).cast("long").alias("foreign_sell_vol"), F.xxhash64("symbol", "date").alias("ingest_seq"))


def actions(spark, rows):
    """Actions of (ex_date, symbol, type, ratio, amount)."""
    return spark.createDataFrame([(d, d, d, s, t, r, a, i) for i, (d, s, t, r, a) in enumerate(rows)],
                                 "ex_date date, record_date date, payment_date date, symbol string, action_type string, ratio double, "
                                 "amount double, ingest_seq long")


def day(y, n):
    return dt.date(y, 1, 1) + dt.timedelta(days=n)


def lake(spark, root, years=(2020, 2021, 2022), symbols="ABCDE"):
    r = random.Random(1)
    rows = [(day(y, n), s, r.randint(900, 1100)) for y in years for n in range(0, 360, 9) for s in symbols if not (s == "E" and y < 2022)]
    acts = [(day(y, r.randrange(360)), s, r.choice(TYPES), r.choice([0.1, 0.5, 2.0, 3.0]), float(r.randint(0, 90))) for y in years for s in "ABC" for _ in range(2)]
    sink.land_daily(bars(spark, rows), root)
    sink.land_corp_actions(actions(spark, acts), root)
    return rows, acts


def got(spark, root):
    return sorted(map(tuple, src.scan_curated(spark, root, "daily_ohlcv").select(*COLS).collect()), key=repr)


def full(spark, root):
    whole = curate.curate_daily_ohlcv(src.scan_daily_layouts(spark, root), src.scan_raw(spark, root, "corp_actions"))
    return sorted(map(tuple, whole.select(*COLS).collect()), key=repr)


def stamps(root):
    """{year: files with their times}"""
    base = f"{root}/curated/daily_ohlcv"
    return {d: sorted((f, os.stat(f"{base}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{base}/{d}")) for d in os.listdir(base) if d.startswith("year=")}


def rewritten(before, after):
    return sorted(int(k[5:]) for k in after if before.get(k) != after[k])


def test_one_action_rewrites_the_years_before_it(spark, tmp_root):
    lake(spark, tmp_root)
    assert jobs.run_curate(spark, tmp_root, "daily_ohlcv")["mode"] == "full"
    assert got(spark, tmp_root) == full(spark, tmp_root)
    for symbol, ex, years in (("D", day(2021, 200), [2020, 2021]), ("E", day(2022, 300), [2022]), ("D", day(2019, 5), [])):
        before = stamps(tmp_root)
        sink.land_corp_actions(actions(spark, [(ex, symbol, "split", 2.0, None)]), tmp_root)
        m = jobs.run_curate(spark, tmp_root, "daily_ohlcv")
        assert m["status"] == "ok" and m["mode"] == "incremental" and m["years"] == years and m["symbols"] == 1 and m["rows_in"] == 0
        assert rewritten(before, stamps(tmp_root)) == years
        assert got(spark, tmp_root) == full(spark, tmp_root)


def test_nothing_new_writes_nothing(spark, tmp_root):
    lake(spark, tmp_root)
    jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    before = stamps(tmp_root)
    m = jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    assert m["rows_in"] == m["rows_out"] == 0 and m["years"] == [] and stamps(tmp_root) == before


def test_a_changed_bar_moves_the_factor_computed_from_it(spark, tmp_root):
    rows, _ = lake(spark, tmp_root)
    on = day(2021, 90)
    sink.land_corp_actions(actions(spark, [(on + dt.timedelta(days=3), "D", "dividend_cash", None, 50.0)]), tmp_root)
    jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    before = stamps(tmp_root)
    sink.land_daily(bars(spark, [(on, "D", 1234)]), tmp_root)
    m = jobs.run_curate(spark, tmp_root, "daily_ohlcv", str(on))
    assert m["years"] == [2020, 2021] == rewritten(before, stamps(tmp_root)) and m["symbols"] == 1
    assert got(spark, tmp_root) == full(spark, tmp_root)
    # a bar that no factor was computed from: its own year only
    sink.land_daily(bars(spark, [(day(2020, 18), "D", 999)]), tmp_root)
    m = jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    assert m["years"] == [2020] and m["symbols"] == 0
    assert got(spark, tmp_root) == full(spark, tmp_root)


def test_other_days_wait_for_their_run(spark, tmp_root):
    lake(spark, tmp_root)
    jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    sink.land_daily(bars(spark, [(day(2022, 361), "A", 1), (day(2022, 362), "A", 2)]), tmp_root)
    m = jobs.run_curate(spark, tmp_root, "daily_ohlcv", str(day(2022, 361)))
    assert m["rows_in"] == 1 and src.scan_curated(spark, tmp_root, "daily_ohlcv").where(F.col("date") == day(2022, 362)).count() == 0
    m = jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    assert m["rows_in"] == 1 and got(spark, tmp_root) == full(spark, tmp_root)


def test_many_random_changes(spark, tmp_root):
    r = random.Random(7)
    lake(spark, tmp_root)
    jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    for _ in range(4):
        sink.land_daily(bars(spark, [(day(r.choice([2020, 2021, 2022, 2023]), r.randrange(360)), s, r.randint(500, 2000))
                                     for s in r.sample("ABCDEFG", 3)]), tmp_root)
        if r.random() < 0.7:
            sink.land_corp_actions(actions(spark, [(day(r.choice([2020, 2021, 2023]), r.randrange(360)), r.choice("ADFG"), r.choice(TYPES),
                                                    r.choice([0.2, 2.0]), float(r.randint(0, 90)))]), tmp_root)
        jobs.run_curate(spark, tmp_root, "daily_ohlcv")
        assert got(spark, tmp_root) == full(spark, tmp_root)


def test_a_run_that_died_before_its_state_is_repeated(spark, tmp_root, monkeypatch):
    lake(spark, tmp_root)
    jobs.run_curate(spark, tmp_root, "daily_ohlcv")
    sink.land_corp_actions(actions(spark, [(day(2021, 200), "D", "split", 2.0, None)]), tmp_root)
    with monkeypatch.context() as m:
        def dies(*_):
            raise RuntimeError("lost")
        m.setattr(daily, "_save", dies)
        assert jobs.run_curate(spark, tmp_root, "daily_ohlcv")["status"].startswith("failed")
    assert jobs.run_curate(spark, tmp_root, "daily_ohlcv")["years"] == [2020, 2021]
    assert got(spark, tmp_root) == full(spark, tmp_root)
    assert len(daily._versions(spark, tmp_root)) == daily.KEEP_VERSIONS


def test_suffix_products_follow_the_order_of_the_full_run(spark):
    rows = [("A", dt.date(2021, m, 1), t, f) for m, t, f in ((3, "split", 0.1), (1, "rights", 1 / 3), (1, "split", 0.7), (2, "merger", 1.0))]
    got = incremental.suffix_products(spark.createDataFrame(rows, "symbol string, ex_date date, action_type string, factor double")).first()
    ordered, want = [f for _, _, _, f in sorted(rows, key=lambda x: (x[1], x[2]))], []
    for i in range(4):
        p = 1.0
        for f in ordered[i:]:
            p *= f
        want.append(p)
    assert [x["product"] for x in got["later"]] == pytest.approx(want, abs=0)
