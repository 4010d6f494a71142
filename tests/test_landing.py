"""Landings as commits: writers that meet, readers during a landing, schemas with versions."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from marketlake.sinks import commits, fs
from marketlake.sinks import lake as sink
from marketlake.sources import lake as src


def bars(spark, *rows, more="", extra=()):
    return spark.createDataFrame([(dt.date.fromisoformat(d), s, c, *extra) for d, s, c in rows], f"date date, symbol string, close long{more}")


def table(root):
    return f"{root}/raw/daily_ohlcv"


def got(spark, root, version=None):
    return sorted((str(r.date), r.symbol, r.close) for r in src.scan_raw(spark, root, "daily_ohlcv", version=version).collect())


def between(monkeypatch, act):
    """Run `act` once, after a landing has written its rows and before it commits."""
    create, done = fs.create_once, []

    def late(*args):
        if not done:
            done.append(1)
            act()
        return create(*args)
    monkeypatch.setattr(fs, "create_once", late)


def test_two_landings_of_one_partition_keep_both(spark, tmp_root, monkeypatch):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1), ("2024-01-03", "A", 7)), tmp_root)
    between(monkeypatch, lambda: sink.land_daily(bars(spark, ("2024-01-02", "B", 2)), tmp_root))
    assert sink.land_daily(bars(spark, ("2024-01-02", "C", 3), ("2024-01-02", "A", 4)), tmp_root) == 3
    want = [("2024-01-02", "A", 4), ("2024-01-02", "B", 2), ("2024-01-02", "C", 3), ("2024-01-03", "A", 7)]
    assert got(spark, tmp_root) == want
    # the folder of the attempt that was given up is gone, and so are the rows that were replaced
    assert sorted((str(r.date), r.symbol, r.close) for r in spark.read.parquet(table(tmp_root)).collect()) == want


def test_landings_of_other_partitions_need_no_second_merge(spark, tmp_root, monkeypatch):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    written, write = [], commits._write
    monkeypatch.setattr(commits, "_write", lambda *a: (written.append(a[1]), write(*a)))
    between(monkeypatch, lambda: sink.land_daily(bars(spark, ("2024-01-05", "B", 2)), tmp_root))
    assert sink.land_daily(bars(spark, ("2024-01-04", "C", 3)), tmp_root) == 3
    assert len(written) == 2
    assert got(spark, tmp_root) == [("2024-01-02", "A", 1), ("2024-01-04", "C", 3), ("2024-01-05", "B", 2)]


def test_first_landings_meet(spark, tmp_root, monkeypatch):
    between(monkeypatch, lambda: sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root))
    sink.land_daily(bars(spark, ("2024-01-02", "B", 2)), tmp_root)
    assert got(spark, tmp_root) == [("2024-01-02", "A", 1), ("2024-01-02", "B", 2)]


def test_writers_in_threads_lose_nothing(spark, tmp_root):
    def run(s):
        for c in range(2):
            sink.land_daily(bars(spark, ("2024-01-02", s, c), ("2024-01-03", s, c)), tmp_root)
    threads = [threading.Thread(target=run, args=(s,)) for s in "ABC"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert got(spark, tmp_root) == [(d, s, 1) for d in ("2024-01-02", "2024-01-03") for s in "ABC"]
    assert commits.snapshot(spark, table(tmp_root)).version == 6


def test_a_reader_sees_whole_landings(spark, tmp_root):
    """A frame made before a landing still has the old rows, all of them, while that version is kept."""
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1), ("2024-01-03", "A", 1)), tmp_root)
    before = src.scan_raw(spark, tmp_root, "daily_ohlcv")
    sink.land_daily(bars(spark, ("2024-01-02", "A", 2), ("2024-01-03", "A", 2)), tmp_root, keep=2)
    assert {r.close for r in before.collect()} == {1}
    assert [c for *_, c in got(spark, tmp_root)] == [2, 2]
    assert [c for *_, c in got(spark, tmp_root, version=1)] == [1, 1]
    assert commits.expire(spark, table(tmp_root)) == 2
    assert [c for *_, c in got(spark, tmp_root)] == [2, 2]


def test_a_landing_that_dies_is_in_no_version(spark, tmp_root, monkeypatch):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    with monkeypatch.context() as m:
        m.setattr(fs, "create_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sink.land_daily(bars(spark, ("2024-01-02", "A", 9)), tmp_root)
    assert got(spark, tmp_root) == [("2024-01-02", "A", 1)]
    assert commits.expire(spark, table(tmp_root), orphans_after_s=3600) == 0
    assert commits.expire(spark, table(tmp_root), orphans_after_s=0) == 1
    assert len([d for d in os.listdir(table(tmp_root)) if d.startswith("commit=")]) == 1


def test_writers_that_never_agree_are_told(spark, tmp_root, monkeypatch):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    n = iter(range(100))
    monkeypatch.setattr(fs, "create_once", lambda *a: False)
    real = commits.snapshot
    monkeypatch.setattr(commits, "snapshot", lambda *a: commits.Snapshot(1, real(*a).schema, {
        p: c if next(n) % 2 == 0 else "other" for p, c in real(*a).folders.items()}))
    monkeypatch.setattr(commits, "_rows", lambda spark, path, snap, touched=None: spark.createDataFrame([], snap.schema))
    with pytest.raises(commits.LandingConflict):
        commits.merge(bars(spark, ("2024-01-02", "B", 2)).withColumn("year", F.year("date")), table(tmp_root), ["year", "date"], ["symbol", "date"], attempts=2)


def test_an_added_column_is_null_in_older_rows(spark, tmp_root):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1), ("2024-01-03", "A", 1)), tmp_root)
    sink.land_daily(bars(spark, ("2024-01-02", "B", 2), more=", vwap double", extra=(1.5,)), tmp_root)
    sink.land_daily(bars(spark, ("2024-01-03", "B", 3)), tmp_root)
    rows = {(str(r.date), r.symbol): r.vwap for r in src.scan_raw(spark, tmp_root, "daily_ohlcv").collect()}
    assert rows == {("2024-01-02", "A"): None, ("2024-01-03", "A"): None, ("2024-01-02", "B"): 1.5, ("2024-01-03", "B"): None}
    assert [(v, "vwap" in s.names) for v, s in commits.schema_versions(spark, table(tmp_root))] == [(1, False), (2, True)]


@pytest.mark.parametrize(("change", "named"), [
    (lambda d: d.withColumn("close", F.col("close").cast("string")), "close is string, the table has bigint"),
    (lambda d: d.withColumn("close", F.lit(1.5)), "close is double, the table has bigint"),
    (lambda d: d.withColumn("novel", F.lit(None)), "novel is new and has no type"),
    (lambda d: d.drop("symbol"), "symbol is missing"),
])
def test_rows_that_do_not_fit_are_refused_by_name(spark, tmp_root, change, named):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    with pytest.raises(commits.SchemaRefused, match=named):
        sink.land_daily(change(bars(spark, ("2024-01-02", "B", 2))), tmp_root)
    assert got(spark, tmp_root) == [("2024-01-02", "A", 1)]


def test_narrower_types_other_case_and_missing_columns_fit(spark, tmp_root):
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    d = bars(spark, ("2024-01-02", "B", 2))
    sink.land_daily(d.select("date", F.col("symbol").alias("Symbol"), F.col("close").cast("int").alias("CLOSE")), tmp_root)
    assert got(spark, tmp_root) == [("2024-01-02", "A", 1), ("2024-01-02", "B", 2)]
    out = src.scan_raw(spark, tmp_root, "daily_ohlcv")
    assert dict(out.dtypes)["close"] == "bigint" and out.where("volume is null and foreign_buy_vol is null").count() == 2


def test_null_keys_and_null_partitions_stay_single(spark, tmp_root):
    rows = spark.createDataFrame([(None, "2024-Q1", dt.date(2024, 1, 1), 1.0), ("A", None, dt.date(2024, 1, 1), 2.0), ("B", "", dt.date(2024, 1, 1), 3.0)],
                                 "symbol string, period string, as_of_date date, pe double")
    for _ in range(2):
        sink.land_fundamentals(rows, tmp_root)
    sink.land_fundamentals(rows.where("symbol = 'A'").withColumn("symbol", F.lit("C")), tmp_root)
    assert sorted(r.pe for r in src.scan_raw(spark, tmp_root, "fundamentals").collect()) == [1.0, 2.0, 2.0, 3.0]


def test_partition_names_with_special_signs(spark, tmp_root):
    d = spark.createDataFrame([("A", "x=1/é%", 1), ("B", "x=1/é%", 2)], "symbol string, part string, v int")
    for s in "AB":
        commits.merge(d.where(F.col("symbol") == s), f"{tmp_root}/t", ["part"], ["symbol"])
    assert sorted((r.symbol, r.part, r.v) for r in commits.read(spark, f"{tmp_root}/t").collect()) == [("A", "x=1/é%", 1), ("B", "x=1/é%", 2)]


def test_a_folder_without_a_log_is_taken_in(spark, tmp_root):
    old = bars(spark, ("2023-01-02", "A", 1), ("2024-01-02", "A", 1)).withColumn("year", F.year("date"))
    old.write.partitionBy("year", "date").parquet(table(tmp_root))
    assert len(got(spark, tmp_root)) == 2
    sink.land_daily(bars(spark, ("2024-01-02", "A", 2), ("2024-01-02", "B", 3)), tmp_root)
    want = [("2023-01-02", "A", 1), ("2024-01-02", "A", 2), ("2024-01-02", "B", 3)]
    assert got(spark, tmp_root) == want and spark.read.parquet(table(tmp_root)).count() == 3


def test_no_rows_make_no_version(spark, tmp_root):
    assert sink.land_daily(bars(spark, ("2024-01-02", "A", 1)).limit(0), tmp_root) == 0
    sink.land_daily(bars(spark, ("2024-01-02", "A", 1)), tmp_root)
    assert sink.land_daily(bars(spark, ("2024-01-02", "A", 1)).limit(0), tmp_root) == 1


def test_only_touched_partitions_are_read(spark, tmp_root, monkeypatch):
    sink.land_daily(bars(spark, *[(f"2024-01-{d:02d}", "A", d) for d in range(1, 20)]), tmp_root)
    plans, write = [], commits._write
    monkeypatch.setattr(commits, "_write", lambda df, *a: (plans.append(df.inputFiles()), write(df, *a)))
    sink.land_daily(bars(spark, ("2024-01-07", "B", 1)), tmp_root)
    assert plans[0] and all("date=2024-01-07" in f for f in plans[0])


def test_a_log_entry_is_created_once(spark, tmp_root):
    for create in (fs.create_once, fs.renamed_once):
        path = f"{tmp_root}/{create.__name__}/1.json"
        assert create(spark, path, "a") and not create(spark, path, "b")
        assert open(path).read() == "a"
        assert [f for f in os.listdir(os.path.dirname(path)) if not f.startswith(".")] == ["1.json"]
