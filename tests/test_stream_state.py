"""Stream operators with timers: absence, low rates, suppression with state that expires."""

import datetime as dt
import os
import tempfile
import time
import uuid

import pytest

from marketlake.streaming import jobs, state

T0 = dt.datetime(2024, 1, 5, 2, 0, 0)
ROWS = "stream string, ts_event timestamp"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Source:
    """A folder that a stream reads one file a trigger, in the order of writing."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path, self.n = spark, schema, tempfile.mkdtemp(prefix="source-"), 0

    def put(self, rows):
        tmp = tempfile.mkdtemp(prefix="part-")
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("overwrite").parquet(tmp)
        part = next(f for f in os.listdir(tmp) if f.startswith("part-") and f.endswith(".parquet"))
        self.n += 1
        os.utime(f"{tmp}/{part}", (time.time() - 1000 + self.n,) * 2)
        os.rename(f"{tmp}/{part}", f"{self.path}/{self.n:04d}.parquet")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def started(df, **trigger):
    name = f"out_{uuid.uuid4().hex}"
    w = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", tempfile.mkdtemp(prefix="ckpt-"))
    return w.trigger(**trigger).start(), name


def result(spark, df, empty_batches="true"):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", empty_batches)
    try:
        q, name = started(df, availableNow=True)
        assert q.awaitTermination(200)
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    return sorted(tuple(r) for r in spark.table(name).collect())


def gaps_of(moments, threshold):
    """(silent from, back at) of a sorted list of seconds."""
    return [(a + threshold, b) for a, b in zip(moments, moments[1:]) if b - a > threshold]


def test_a_stream_that_stops_is_reported_without_input_of_its_own(spark):
    src = Source(spark, ROWS)
    src.put([("a", at(0)), ("b", at(5))])
    src.put([("a", at(60)), ("b", at(100))])
    src.put([("b", at(150))])
    src.put([("b", at(260))])  # the watermark passes 60 + 120 s by rows of b alone
    src.put([("b", at(300))])
    assert result(spark, state.silence_stream(src.stream(), threshold_s=120, delay="10 seconds")) == [("a", "silent", at(60), at(180))]


def test_silence_ends_and_late_gaps_inside_a_batch_are_seen(spark):
    src = Source(spark, ROWS)
    a = [0, 10, 400, 405, 1000]
    src.put([("a", at(s)) for s in a[:2]] + [("b", at(s)) for s in range(0, 50, 10)])
    src.put([("b", at(s)) for s in range(50, 300, 10)])
    src.put([("b", at(s)) for s in range(300, 390, 10)])
    src.put([("a", at(s)) for s in a[2:]] + [("b", at(s)) for s in range(390, 1001, 10)])
    got = result(spark, state.silence_stream(src.stream(), threshold_s=120, delay="10 seconds"))
    want = [("a", "silent", at(10), at(130)), ("a", "back", at(10), at(400)), ("a", "silent", at(405), at(525)), ("a", "back", at(405), at(1000))]
    assert got == sorted(want)
    assert [(w[3] - T0).total_seconds() for w in want] == [x for g in gaps_of(a, 120) for x in g]


def test_a_stream_that_never_sends_is_reported(spark):
    src = Source(spark, "stream string, max_ts timestamp")
    src.put([("ticks", at(30))])
    src.put([("ticks", at(200))])
    src.put([("ticks", at(400))])
    src.put([("ticks", at(401))])
    got = result(spark, state.coverage_alerts(src.stream(), start=T0, minutes=5))
    assert got == [(s, "silent", at(0), at(300)) for s in ("index_values", "quotes_l1", "quotes_l2")]


def test_heartbeat_runs_out_by_the_clock(spark):
    src = Source(spark, ROWS)
    src.put([("a", at(0))])
    q, name = started(state.heartbeat_stream(src.stream(), threshold_s=3), processingTime="1 second")
    try:
        assert waited(spark, name, "kind = 'silent'")
        src.put([("a", at(1))])
        assert waited(spark, name, "kind = 'back'")
    finally:
        q.stop()


def test_low_rate(spark):
    src = Source(spark, ROWS)
    busy = lambda key, lo, hi, step: [(key, at(s)) for s in range(lo, hi, step)]
    # 0.1 rows a second over 120 s are 12 rows: a sends 40, then 4, then nothing, then 40
    src.put(busy("a", 0, 120, 3) + busy("b", 0, 120, 2))
    src.put(busy("a", 120, 240, 30) + busy("b", 120, 240, 2))
    for lo in range(240, 960, 120):
        src.put(busy("b", lo, lo + 120, 2) + (busy("a", lo, lo + 120, 3) if lo == 720 else []))
    got = result(spark, state.low_rate_stream(src.stream(), rate=0.1, for_s=120, step_s=60, delay="1 second"))
    assert [g for g in got if g[0] == "b"] == []
    first = [g for g in got if g[0] == "a"]
    assert ("a", "low", 4, at(240)) in first and ("a", "back", 20, at(780)) in first
    assert all(k in ("low", "back") for _, k, _, _ in got)


ALERTS = "alert_key string, alert_id long, ts timestamp, severity string"


def sequential(rows, ttl=600):
    out, expires = {}, {}
    for key, i, ts, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        out[i] = not (key in expires and expires[key] > ts)
        if out[i]:
            expires[key] = ts + dt.timedelta(seconds=ttl)
    return out


@pytest.mark.parametrize("triggers", [1, 5])
def test_suppression_over_triggers(spark, triggers):
    rows = [(f"k{i % 3}", i, at(37 * i + (i * i) % 11), "error") for i in range(200)]
    src = Source(spark, ALERTS)
    n = len(rows) // triggers
    for t in range(triggers):
        src.put(rows[t * n: (t + 1) * n])
    got = result(spark, state.suppress_stream(src.stream()), "false")
    assert {r[1]: r[4] for r in got} == sequential(rows)


def waited(spark, name, condition, seconds=90):
    """Whether rows that meet the condition have come; a query with clock timers never runs out of work to wait for."""
    end = time.time() + seconds
    while time.time() < end:
        if spark.table(name).where(condition).count():
            return True
        time.sleep(0.5)
    return False


def test_suppression_state_expires(spark):
    src = Source(spark, ALERTS)
    src.put([("k", 1, at(0), "error")])
    q, name = started(state.suppress_stream(src.stream(), keep_s=2), processingTime="1 second")
    try:
        assert waited(spark, name, "alert_id = 1")
        time.sleep(4)
        src.put([("k", 2, at(10), "error"), ("other", 3, at(10), "error")])
        assert waited(spark, name, "alert_id = 2") and waited(spark, name, "alert_id = 3")
        # its window is open until 600 s, but its state was kept for 2 s only
        assert {r.alert_id: r.sent for r in spark.table(name).collect()} == {1: True, 2: True, 3: True}
    finally:
        q.stop()


def test_drain_flushes_what_has_arrived(spark):
    from marketlake.bindings import TestLake
    from tests.conftest import SF_SMALL
    lk = TestLake(spark, SF_SMALL)
    src, root, ck = (tempfile.mkdtemp(prefix=p) for p in ("msg-", "lake-", "ckpt-"))
    lk.messages_raw.coalesce(2).write.mode("overwrite").json(src)
    q = jobs.start_ingest(spark, src, root, ck, interval="1 hour")
    jobs.drain(q, spark, src, root, ck)
    assert not q.isActive
    assert spark.read.parquet(f"{root}/raw/ticks").count() == lk.accepted_ticks.count()
