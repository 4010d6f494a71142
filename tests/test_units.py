"""Literal cases mirroring the reference's unit tests."""

import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions.prices import action_factor, l1_derived
from marketlake.operators import alerts, calendar, ingest, refdata
from marketlake.operators.adjust import adjust_prices
from marketlake.operators.curate import curate_ticks
from marketlake.operators.dedup import dedup_first
from marketlake.sources import jsonl

D = dt.date


def bars(spark, closes, start=D(2024, 1, 1), sym="VNM"):
    rows = [(start + dt.timedelta(days=i), sym, c) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "date date, symbol string, close long")


def actions(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ex_date date, action_type string, ratio double, amount double")


def adj(spark, closes, acts):
    out = adjust_prices(bars(spark, closes), actions(spark, acts)).orderBy("date")
    return [r.adj_close for r in out.collect()]


def test_no_actions(spark):
    assert adj(spark, [850000, 855000], []) == [850000, 855000]


def test_split_two_for_one(spark):
    a = [("VNM", D(2024, 1, 3), "split", 2.0, None)]
    assert adj(spark, [1000000, 1010000, 500000], a) == [500000, 505000, 500000]


def test_cash_dividend(spark):
    a = [("VNM", D(2024, 1, 2), "dividend_cash", None, 100.0)]
    assert adj(spark, [1000, 900], a) == [900, 900]


def test_stock_dividend(spark):
    a = [("VNM", D(2024, 1, 2), "dividend_stock", 0.1, None)]
    got = adj(spark, [1000, 909], a)
    assert abs(got[0] - 909) <= 1 and got[1] == 909


def test_missing_prev_close_and_noop_types(spark):
    a = [("VNM", D(2024, 1, 1), "dividend_cash", None, 100.0),   # no earlier close -> factor 1
         ("VNM", D(2024, 1, 2), "merger", 1.0, None), ("VNM", D(2024, 1, 2), "unknown", 1.0, None)]
    assert adj(spark, [1000, 1000], a) == [1000, 1000]


def test_action_factor_rules(spark):
    rows = [("split", 2.0, None, 100), ("split", 0.0, None, 100), ("rights", 0.25, None, 100),
            ("dividend_cash", None, 0.0, 100), ("dividend_cash", None, 10.0, None),
            ("dividend_cash", None, 10.0, 100), ("merger", 5.0, 5.0, 100)]
    df = spark.createDataFrame(rows, "action_type string, ratio double, amount double, close_prev long")
    got = [r.f for r in df.select(action_factor().alias("f")).collect()]
    assert got == [0.5, 1.0, 0.8, 1.0, 1.0, 0.9, 1.0]


def test_dedup_three_part_key(spark):
    t = dt.datetime(2024, 1, 2, 9, 0)
    rows = [(t, t, "VNM", "equity", "HOSE", 1, 1, "continuous", "B", tid, s, D(2024, 1, 2))
            for tid, s in (("T1", 1), ("T1", 2), ("T2", 3))]
    df = spark.createDataFrame(rows, "ts_event timestamp, ts_received timestamp, symbol string, asset_class string, "
                                     "exchange string, price long, volume long, match_type string, side string, "
                                     "trade_id string, seq long, date date")
    assert curate_ticks(df).count() == 2


def test_dedup_sort_decides_winner(spark):
    df = spark.createDataFrame([("VNM", 1, 851000), ("VNM", 1, 850000)], "symbol string, t int, price long")
    out = dedup_first(df, ["symbol", "t"], ["price"]).collect()
    assert [r.price for r in out] == [850000]


def test_l1_derived(spark):
    df = spark.createDataFrame([(100, 102), (0, 102), (100, 0), (100, 100), (102, 100)],
                               "bid_price long, ask_price long")
    got = [(r.mid_price, r.spread_bps) for r in l1_derived(df).collect()]
    assert got[0] == (101, 198)
    assert got[1] == (None, None) and got[2] == (None, None)
    assert got[3] == (100, 0)
    assert got[4][1] < 0


def test_daily_scaling(spark):
    v = spark.createDataFrame([("VNM", dt.datetime(2024, 1, 2), 85.0, 86.0, 84.5, 85.5, 100000.0)],
                              "symbol string, time timestamp, open double, high double, low double, close double, "
                              "volume double")
    r = refdata.normalize_daily(v).first()
    assert r.close == 855 and r.volume == 100000 and r.value == 855 * 100000
    assert r.foreign_buy_vol is None


def test_quarterly_window(spark):
    ds = [D(2024, 4, 30), D(2024, 4, 27), D(2024, 5, 1) - dt.timedelta(days=1), D(2024, 7, 31),
          D(2024, 1, 28), D(2024, 4, 26), D(2024, 5, 1)]
    df = spark.createDataFrame([(d,) for d in ds], "d date")
    got = [r.f for r in df.select(refdata.is_quarterly_report_date("d").alias("f")).collect()]
    assert got == [True, True, True, True, True, False, False]


def test_bad_ticks_rejected(spark):
    base = dict(S="VNM", P=1000, V=100, T=1704186000000, TID="T1", SEQ=1)
    import json
    msgs = [json.dumps({**base, "P": -1}), json.dumps({**base, "V": -100}),
            json.dumps({k: v for k, v in base.items() if k != "TID"}), json.dumps({**base, "P": "abc"}),
            json.dumps(base)]
    df = spark.createDataFrame([(i, "tick", m, dt.datetime(2024, 1, 2)) for i, m in enumerate(msgs)],
                               "msg_id long, channel string, payload string, ts_received timestamp")
    v = ingest.validate_rows(ingest.parse_ticks(df), "ticks")
    ok, bad = ingest.split_rejects(v)
    errs = ingest.parse_errors(df)
    assert [r.msg_id for r in ok.collect()] == [4]
    assert sorted(r.msg_id for r in bad.collect()) == [0, 1]
    assert sorted(r.msg_id for r in errs.collect()) == [2, 3]


DOC_2026 = ('{"year": 2026, "trading_days": ["2026-01-02", "2026-01-05", "2026-01-06"], '
            '"holidays": [{"date": "2026-01-01", "name": "New Year\'s Day"}, {"date": "2026-04-30", "name": "Reunification Day"}], '
            '"sessions": {"equity": [["09:00", "11:30"], ["13:00", "14:45"]], '
            '"derivative": [["08:45", "11:30"], ["13:00", "14:45"]]}}')


def documents(spark, *docs):
    return calendar.read_calendar(spark.createDataFrame([(d,) for d in docs], "value string"))


def test_trading_day_flags(spark):
    """A weekday that the document does not list is closed, with or without a holiday's name."""
    probe = spark.createDataFrame([(D(2026, 1, 2),), (D(2026, 4, 30),), (D(2026, 1, 3),), (D(2026, 1, 7),)], "date date")
    cal = documents(spark, DOC_2026)
    got = {r.date: (r.is_trading_day, r.holiday_name) for r in calendar.trading_day_flags(probe, cal).collect()}
    assert got == {D(2026, 1, 2): (True, None), D(2026, 4, 30): (False, "Reunification Day"), D(2026, 1, 3): (False, None),
                   D(2026, 1, 7): (False, None)}


def test_missing_days_follow_the_document(spark):
    bars = spark.createDataFrame([("A", D(2026, 1, 2)), ("A", D(2026, 1, 6))], "symbol string, date date")
    assert [r.date for r in calendar.missing_days(bars, documents(spark, DOC_2026)).collect()] == [D(2026, 1, 5)]
    other = DOC_2026.replace('"2026-01-05", ', '')
    assert calendar.missing_days(bars, documents(spark, other)).count() == 0


def test_read_calendar_document(spark):
    days, hol, ses = documents(spark, DOC_2026, "not json")
    assert [r.date for r in days.orderBy("date").collect()] == [D(2026, 1, 2), D(2026, 1, 5), D(2026, 1, 6)]
    assert hol.orderBy("date").first().name == "New Year's Day"
    eq = ses.where("calendar_class = 'equity' AND session_no = 1").first()
    assert eq.start_us == 9 * 3600 * 10**6 and eq.end_us == (11 * 3600 + 30 * 60) * 10**6


def test_quoted_and_fractional_wire_numbers(spark):
    rows = [(0, "tick", '{"S":"A","P":"850000","V":100.0,"T":"1700000000000","TID":"t","SEQ":7}'),
            (1, "tick", '{"S":"A","P":"high","V":1,"T":1700000000000,"TID":"t","SEQ":7}')]
    df = spark.createDataFrame(rows, "msg_id long, channel string, payload string").withColumn("ts_received", F.current_timestamp())
    got = ingest.parse_ticks(df).collect()
    assert [(r.msg_id, r.price, r.volume, r.seq) for r in got] == [(0, 850000, 100, 7)]
    assert ingest.parse_errors(df).first().error == "missing:P"


def test_zero_close_and_backward_gap(spark):
    from marketlake.operators import analytics, research
    daily = spark.createDataFrame([("A", D(2024, 1, 2), 0), ("A", D(2024, 1, 3), 5)], "symbol string, date date, close long") \
        .withColumns({"high": F.col("close"), "low": F.col("close"), "volume": F.lit(1)})
    assert research.symbol_kpis(daily).first().period_pct is None
    assert research.symbol_summary(daily).first().change_pct is None
    assert research.indexed(daily).orderBy("date").collect()[1].indexed is None
    gaps = spark.createDataFrame([("ticks", D(2024, 1, 5), D(2024, 1, 2), "x"), ("ticks", D(2024, 1, 8), None, "y")],
                                 "stream string, start date, end date, reason string")
    out = analytics.gap_filled(daily.select("date"), gaps).where("gap_reason is not null").collect()
    assert [(r.date, r.gap_reason) for r in out] == [(D(2024, 1, 8), "y")]


def test_gaps_file_skips_bad_lines(spark):
    lines = ['{"stream": "ticks", "start": "2024-01-02", "end": "2024-01-03", "reason": "x"}',
             "not json", "", '{"stream": "ticks", "start": "soon", "end": "2024-01-05", "reason": "y"}']
    g = jsonl.read_gaps(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert len(g) == 2
    assert g[0].start == D(2024, 1, 2) and g[1].start is None and g[1].end == D(2024, 1, 5)


def test_alert_key_sanitised(spark):
    df = spark.createDataFrame([("a/b", "error", "x" * 2000)], "n string, s string, c string")
    k = df.select(alerts.alert_key(F.col("n"), F.col("s"), F.col("c")).alias("k")).first().k
    assert k.startswith("a_b|error|") and len(k) == 1500


def test_bucket_balance(spark):
    from marketlake.functions.prices import bucket_symbol
    df = spark.range(1600).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"))
    counts = [r["count"] for r in df.groupBy(bucket_symbol("symbol", 4)).count().collect()]
    assert len(counts) == 4 and all(abs(c - 400) <= 120 for c in counts)


def test_plan_chunks(spark):
    days = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(10)], "date date")
    ch = sorted((r.chunk, r.start, r.end) for r in refdata.plan_chunks(days, 3).collect())
    assert [(c[2] - c[1]).days + 1 for c in ch] == [4, 3, 3]
    assert ch[0][1] == D(2024, 1, 1) and ch[-1][2] == D(2024, 1, 10)
    assert refdata.plan_chunks(days, 50).count() == 10


def test_source_priority_falls_through_on_error_only(spark):
    rows = [("primary", 1, "A", "ok"), ("secondary", 2, "A", "ok"),
            ("primary", 1, "B", "error"), ("secondary", 2, "B", "ok"),
            ("primary", 1, "C", "error"), ("secondary", 2, "C", "error")]
    df = spark.createDataFrame(rows, "source string, rank int, symbol string, status string")
    got = {r.symbol: (r.source, r.status) for r in refdata.source_priority(df).collect()}
    assert got == {"A": ("primary", "ok"), "B": ("secondary", "ok"), "C": (None, "all_sources_failed")}


def test_plan_chunks_edges(spark):
    import pytest
    days = spark.createDataFrame([(D(2024, 1, 1),)], "date date")
    with pytest.raises(ValueError):
        refdata.plan_chunks(days, 0)
    assert refdata.plan_chunks(spark.createDataFrame([], "date date"), 3).count() == 0
    one = refdata.plan_chunks(days, 5).collect()
    assert [(r.chunk, r.start, r.end) for r in one] == [(1, D(2024, 1, 1), D(2024, 1, 1))]


def test_alert_parse_json_and_plain(spark):
    import base64
    import json

    def b64(s):
        return base64.b64encode(s.encode()).decode()
    rows = [(1, b64(json.dumps({"name": "disk", "severity": "error", "body": "full", "scope": ""})),
             {"scope": "node/1", "source": "ops"}),
            (2, b64("plain text"), {"alert_name": "cpu", "severity": "warning"}),
            (3, b64("plain text"), {"source": "ops"}),
            (4, "%%%not-base64", {})]
    df = spark.createDataFrame(rows, "alert_id long, data string, attributes map<string,string>")
    got = {r.alert_id: (r.name, r.severity, r.body, r.scope, r.source) for r in alerts.alert_parse(df).collect()}
    assert got[1] == ("disk", "error", "full", "node/1", "ops")
    assert got[2] == ("cpu", "warning", "plain text", "", None)
    assert got[3] == ("ops", "info", "plain text", "", "ops")
    assert 4 not in got


def test_replay_sets_replay_of(spark):
    from marketlake.operators.ops import replay_dead_letters
    df = spark.createDataFrame([("x", {"topic": "ticks", "replay_of": "old"}, None)],
                               "data string, attributes map<string,string>, publish_time string")
    a = replay_dead_letters(df, "dead-letters/ticks.jsonl").first().attributes
    assert a == {"topic": "ticks", "replay_of": "dead-letters/ticks.jsonl"}


def test_in_session_bounds_inclusive_on_exchange_clock(spark):
    # 02:00 UTC = 09:00 local (open), 04:30 = 11:30 (close, inclusive), 04:30:01 just after;
    # futures open at 08:45 local = 01:45 UTC; a day that is not listed is never in session
    t = dt.datetime
    rows = [(1, t(2024, 1, 2, 2, 0, 0), "equity"), (2, t(2024, 1, 2, 4, 30, 0), "equity"),
            (3, t(2024, 1, 2, 4, 30, 1), "equity"), (4, t(2024, 1, 2, 1, 45, 0), "future"),
            (5, t(2024, 1, 2, 1, 45, 0), "equity"), (6, t(2024, 1, 7, 3, 0, 0), "equity")]
    df = spark.createDataFrame(rows, "id int, ts_event timestamp, asset_class string")
    doc = DOC_2026.replace("2026", "2024")
    got = {r.id: r.in_session for r in calendar.in_session(df, documents(spark, doc)).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
