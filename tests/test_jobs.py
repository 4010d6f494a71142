"""Writers and job plans on a scratch lake built from the smallest tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.bindings import TestLake
from marketlake.plans import jobs
from marketlake.sinks import lake as sink
from marketlake.sources import lake as src
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="marketlake-lake-")
    lk = TestLake(spark, SF_SMALL)
    sink.land_stream(lk.ticks_raw, root, "ticks", "0")
    sink.land_stream(lk.quotes_l1_raw, root, "quotes_l1", "0")
    sink.land_stream(lk.quotes_l2_raw, root, "quotes_l2", "0")
    sink.land_stream(lk.index_raw, root, "index_values", "0")
    sink.land_daily(lk.daily_raw, root)
    sink.land_corp_actions(lk.corp_actions_raw, root)
    sink.land_fundamentals(lk.fundamentals_raw.withColumn("quarter", F.col("period")), root)
    return root, lk


def _same(a, b, cols):
    return sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_curate_ticks_idempotent(spark, landed):
    root, lk = landed
    m1 = jobs.run_curate(spark, root, "ticks")
    m2 = jobs.run_curate(spark, root, "ticks")
    cur = src.scan_curated(spark, root, "ticks")
    assert m1["rows_in"] == lk.ticks_raw.count() and m1["rows_out"] == m2["rows_out"]
    assert cur.count() == lk.curated_ticks.count()
    assert _same(cur, lk.curated_ticks, ["symbol", "ts_event", "trade_id", "price", "ts_received"])


def test_curate_daily_matches_query(spark, landed):
    root, lk = landed
    jobs.run_curate(spark, root, "daily_ohlcv")
    cur = src.scan_curated(spark, root, "daily_ohlcv")
    assert _same(cur, lk.curated_daily, ["date", "symbol", "close", "adj_close"])


def test_curate_one_day_prunes_partitions(spark, landed):
    root, lk = landed
    day = lk.ticks_raw.agg(F.min("date")).first()[0]
    m = jobs.run_curate(spark, root, "quotes_l1", str(day))
    assert m["rows_in"] == lk.quotes_l1_raw.where(F.col("date") == F.lit(day)).count()
    plan = src.scan_raw(spark, root, "ticks").where(F.col("date") == F.lit(str(day)).cast("date"))
    assert "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().executedPlan().toString()


def test_eod_gate(spark, landed):
    root, lk = landed
    sat = dt.date(2024, 1, 6)
    assert jobs.run_eod(spark, root, sat, lk.calendar)["status"].startswith("skipped")
    closed = dt.date(2024, 1, 15)  # a Monday that the documents do not list
    assert jobs.run_eod(spark, root, closed, lk.calendar)["status"].startswith("skipped")
    out = jobs.run_eod(spark, root, dt.date(2024, 1, 5), lk.calendar, streams=("ticks", "index_values"))
    assert out["status"] == "ok" and {o["stream"] for o in out["curated"]} == {"ticks", "index_values", "daily_ohlcv"}


def test_eod_lands_and_lists_errors(spark, landed):
    root, lk = landed
    on = dt.date(1996, 4, 29)  # a filing date, and a trading day

    def broken():
        raise RuntimeError("no answer")
    out = jobs.run_eod(spark, root, on, lk.calendar, {
        "daily_ohlcv": lk.vendor_daily, "fundamentals": lk.vendor_fundamentals, "corp_actions": broken},
        streams=("ticks", "no_such_stream"))
    assert out["landed"]["daily_ohlcv"] == lk.vendor_daily.where(F.to_date("time") == F.lit(on)).count()
    assert out["landed"]["fundamentals"] == lk.vendor_fundamentals.count()
    assert {e["stream"] for e in out["errors"]} == {"corp_actions", "no_such_stream"}
    assert "no answer" in next(e["error"] for e in out["errors"] if e["stream"] == "corp_actions")
    assert next(m for m in out["curated"] if m["stream"] == "ticks")["status"] == "ok"


def test_backfill_chunks_cover_range_and_skip_present(spark, landed):
    root, lk = landed
    s1 = jobs.run_backfill(spark, root, lk.vendor_daily, "1996-01-01", "1996-12-31", 4).collect()
    landed_rows = spark.read.parquet(f"{root}/raw/daily_ohlcv_backfill").count()
    assert sum(r.rows for r in s1) == landed_rows > 0
    ch = sorted(s1)
    assert all((b.start - a.end).days == 1 for a, b in zip(ch, ch[1:]))
    s2 = jobs.run_backfill(spark, root, lk.vendor_daily, "1996-01-01", "1996-12-31", 4).collect()
    assert sum(r.rows for r in s2) == 0
    gaps = spark.read.json(f"{root}/_ops/permanent-gaps/ticks.jsonl")
    assert gaps.count() == 1  # the second run replaces the record of the first


def test_backfill_other_symbols_of_the_same_days(spark, tmp_root):
    lk = TestLake(spark, SF_SMALL)
    a = lk.vendor_daily.where("symbol = 'S1'")
    b = lk.vendor_daily.where("symbol = 'S2'")
    n = [sum(r.rows for r in jobs.run_backfill(spark, tmp_root, x, "1996-01-01", "1998-12-31", 3).collect()) for x in (a, b)]
    assert n[0] > 0 and n[1] > 0
    assert spark.read.parquet(f"{tmp_root}/raw/daily_ohlcv_backfill").count() == sum(n)

    def broken():
        raise RuntimeError("no answer")
    rest = jobs.run_backfill(spark, tmp_root, a, "1996-01-01", "1998-12-31", 3, fundamentals=lk.vendor_fundamentals,
                             corp_actions=broken, reference={"tickers": lk.vendor_tickers}).collect()
    by = {r.stream: r for r in rest}
    assert by["fundamentals"].rows > 0 and by["tickers"].rows == lk.vendor_tickers.count()
    assert by["corp_actions"].errors and by["fundamentals"].errors is None


def test_reference_and_dq(spark, landed):
    root, lk = landed
    counts = jobs.run_reference(spark, root, lk.vendor_tickers, lk.vendor_futures, "2024-03-01")
    assert counts["tickers"] == lk.vendor_tickers.count()
    for s in ("ticks", "quotes_l1", "quotes_l2", "corp_actions"):
        jobs.run_curate(spark, root, s)
    jobs.run_curate(spark, root, "daily_ohlcv")
    dq = {r.validator: r.findings for r in jobs.run_dq(spark, root, lk.calendar).collect()}
    assert set(dq) == {"tick_vs_daily", "l1_vs_l2", "corp_actions_applied", "corp_actions_applied_fixed",
                       "missing_days"}
    assert dq["l1_vs_l2"] > 0


def test_curated_views_and_ddl(spark, landed):
    root, lk = landed
    jobs.run_curate(spark, root, "ticks")
    made = src.register_views(spark, root)
    assert "ticks" in made
    assert spark.sql("SELECT count(*) AS n FROM ticks").first().n == lk.curated_ticks.count()
    ddl = src.curated_table_ddl(root)
    db = f"market_{root[-6:].lower().replace('-', '_')}"
    for statement in src.curated_table_ddl(root, db):
        spark.sql(statement)
    assert len([t for t in spark.catalog.listTables(db) if not t.isTemporary]) == len(ddl) - 1
    spark.sql(f"MSCK REPAIR TABLE {db}.ticks")
    assert spark.table(f"{db}.ticks").count() == lk.curated_ticks.count()
    spark.sql(f"DROP DATABASE {db} CASCADE")
    out = src.run_sql(spark, "SELECT count(*) AS n FROM ticks WHERE date >= :d", d=dt.date(2024, 1, 15))
    assert 0 < out.first().n < lk.curated_ticks.count()


def _bars(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), s, c) for d, s, c in rows], "date date, symbol string, close long")


def test_landing_keeps_other_rows(spark, tmp_root):
    """In a session with static overwrite: other symbols, days and earlier actions stay."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        sink.land_daily(_bars(spark, ("2024-01-02", "A", 1)), tmp_root)
        sink.land_daily(_bars(spark, ("2024-01-02", "B", 2)), tmp_root)
        sink.land_daily(_bars(spark, ("2023-05-02", "A", 3)), tmp_root)
        sink.land_daily(_bars(spark, ("2024-01-02", "A", 4)), tmp_root)
        got = {(str(r.date), r.symbol, r.close) for r in spark.read.parquet(f"{tmp_root}/raw/daily_ohlcv").collect()}
        assert got == {("2024-01-02", "A", 4), ("2024-01-02", "B", 2), ("2023-05-02", "A", 3)}
        for ex in ("2024-02-01", "2024-07-01"):
            for s in "AB":
                sink.land_corp_actions(spark.createDataFrame(
                    [(dt.date.fromisoformat(ex), s, "split", 2.0)], "ex_date date, symbol string, action_type string, ratio double"), tmp_root)
        assert spark.read.parquet(f"{tmp_root}/raw/corp_actions").count() == 4
        one = spark.createDataFrame([("A", dt.date(2024, 1, 1), "2024-Q1", 1.0)], "symbol string, as_of_date date, period string, pe double")
        sink.land_fundamentals(one, tmp_root)
        sink.land_fundamentals(one.withColumn("symbol", F.lit("B")), tmp_root)
        assert spark.read.parquet(f"{tmp_root}/raw/fundamentals").count() == 2
        day = lambda d: _bars(spark, (d, "A", 1)).withColumn("year", F.year("date"))
        sink.write_curated(day("2023-01-03"), tmp_root, "daily_ohlcv")
        sink.write_curated(day("2024-01-03"), tmp_root, "daily_ohlcv")
        assert src.scan_curated(spark, tmp_root, "daily_ohlcv").count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_dq_reports_a_failing_validator(spark):
    from marketlake.operators.quality import dq_summary
    ok = spark.range(3)
    fails = spark.range(3).select(F.raise_error(F.lit("bad")).alias("x"))
    got = {r.validator: (r.findings, r.alert) for r in dq_summary({"ok": ok, "fails": lambda: fails.where("x is null")}).collect()}
    assert got == {"ok": (3, True), "fails": (-1, True)}


def test_receipts_land_read_cover(spark, tmp_root):
    from marketlake.operators import ingest, ops
    from marketlake.sources import jsonl
    lk = TestLake(spark, SF_SMALL)
    for s in ("ticks", "quotes_l1", "index_values"):
        ok, _ = ingest.split_rejects(ingest.validated(lk.messages_raw, s))
        for _again in range(2):
            sink.write_receipts(ingest.receipts(ok, s, "7"), tmp_root, "7")
    rc = jsonl.read_receipts(jsonl.text_lines(spark, f"{tmp_root}/_ops/ingest-receipts"))
    assert rc.where("stream is null or date is null or symbol is null").count() == 0
    assert rc.where("stream = 'ticks'").agg(F.sum("rows")).first()[0] == lk.accepted_ticks.count()
    got = {r.stream: r for r in ops.coverage(rc, minutes=60 * 24 * 400).collect()}
    assert set(got) == {"ticks", "quotes_l1", "quotes_l2", "index_values"}
    assert got["quotes_l2"].alert and got["quotes_l2"].recent_files == 0 and not got["index_values"].alert


def test_dead_letter_export_survives_a_second_run(spark, tmp_root):
    from marketlake.operators import ops
    from marketlake.sources import jsonl
    lk = TestLake(spark, SF_SMALL)
    lines = ops.export_dead_letters(jsonl.read_dead_letters(lk.dead_letter_lines))
    n = [sum(r.messages for r in sink.export_dead_letters(lines, tmp_root, run).collect()) for run in ("a", "a", "b")]
    assert n[0] == n[1] == n[2] > 0
    assert spark.read.text(f"{tmp_root}/_ops/dead-letters").count() == 2 * n[0]


def test_a_failing_reference_table_does_not_stop_the_other(spark, tmp_root):
    lk = TestLake(spark, SF_SMALL)
    broken = lk.vendor_tickers.select(F.raise_error(F.lit("no answer")).cast("string").alias("symbol"))
    out = jobs.run_reference(spark, tmp_root, broken, lk.vendor_futures, "2024-03-01")
    assert out["tickers"] == 0 and [e["stream"] for e in out["errors"]] == ["tickers"]
    assert out["futures_contracts"] == lk.vendor_futures.count()
