"""Streaming jobs equal their batch operators on the same input."""

import tempfile

from pyspark.sql import functions as F

from marketlake.bindings import TestLake
from marketlake.operators import alerts as al
from marketlake.streaming import jobs as st
from marketlake.streaming import state
from tests.conftest import SF_SMALL


def _count(spark, path):
    import glob
    if not glob.glob(f"{path}/**/*.parquet", recursive=True):
        return 0
    return spark.read.parquet(path).count()


def test_ingest_equals_batch(spark):
    lk = TestLake(spark, SF_SMALL)
    srcdir, root, ck = (tempfile.mkdtemp(prefix=p) for p in ("msg-", "lake-", "ckpt-"))
    lk.messages_raw.repartition(3).write.mode("overwrite").json(srcdir)
    q = st.start_ingest(spark, srcdir, root, ck, available_now=True)
    q.awaitTermination(600)
    landed = spark.read.parquet(f"{root}/raw/ticks")
    assert landed.count() == lk.accepted_ticks.count()
    rc = spark.read.json(f"{root}/_ops/ingest-receipts").where(F.col("stream") == "ticks")
    assert rc.agg(F.sum("rows")).first()[0] == landed.count()
    parse_err = _count(spark, f"{root}/_ops/parse-errors")
    rejected = sum(_count(spark, f"{root}/_ops/rejected/{s}")
                   for s in ("ticks", "quotes_l1", "quotes_l2", "index_values"))
    accepted = sum(_count(spark, f"{root}/raw/{s}")
                   for s in ("ticks", "quotes_l1", "quotes_l2", "index_values"))
    assert parse_err > 0 and rejected > 0
    assert accepted + rejected + parse_err == lk.messages_raw.count()


def test_replayed_batch_lands_once(spark):
    lk = TestLake(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="lake-")
    first = st.land_batch(lk.messages_raw, root, 3)
    before = {s: _count(spark, f"{root}/raw/{s}") for s in first}
    receipts = spark.read.json(f"{root}/_ops/ingest-receipts").count()
    assert st.land_batch(lk.messages_raw, root, 3) == first == before
    assert {s: _count(spark, f"{root}/raw/{s}") for s in first} == before
    assert spark.read.json(f"{root}/_ops/ingest-receipts").count() == receipts


def test_stream_dedup_equals_batch(spark):
    lk = TestLake(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="ticks-")
    lk.ticks_raw.write.mode("overwrite").parquet(d)
    s = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    q = (st.dedup_stream(s).writeStream.format("memory").queryName("dedup_out")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert spark.table("dedup_out").count() == lk.curated_ticks.count()


def test_stream_suppression_equals_batch(spark):
    lk = TestLake(spark, SF_SMALL)
    parsed = al.alert_parse(lk.alerts_raw)
    keyed = parsed.select("alert_id", "ts", "severity",
                          al.alert_key(F.col("name"), F.col("severity"), F.col("scope")).alias("alert_key"))
    d = tempfile.mkdtemp(prefix="alerts-")
    # several micro-batches in time order, so that state is carried from one to the next
    import os
    import time
    keyed.repartitionByRange(4, "ts").write.mode("overwrite").parquet(d)
    for i, f in enumerate(sorted(x for x in os.listdir(d) if x.startswith("part-"))):
        os.utime(f"{d}/{f}", (time.time() - 100 + i, time.time() - 100 + i))
    s = spark.readStream.schema(spark.read.parquet(d).schema).option("maxFilesPerTrigger", 1).parquet(d)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = (state.suppress_stream(s).writeStream.format("memory").queryName("supp_out").outputMode("append")
             .trigger(availableNow=True).start())
        assert q.awaitTermination(200)
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    got = {r.alert_id: r.sent for r in spark.table("supp_out").collect()}
    exp = {r.alert_id: r.sent for r in al.suppress(spark.read.parquet(d)).collect()}
    assert got == exp


def test_coverage_stream_counts_receipts(spark):
    from marketlake.operators import ingest
    from marketlake.operators.ops import coverage_windows
    lk = TestLake(spark, SF_SMALL)
    rc = ingest.receipts(lk.accepted_ticks, "ticks")
    d = tempfile.mkdtemp(prefix="receipts-")
    rc.write.mode("overwrite").parquet(d)
    s = spark.readStream.schema(spark.read.parquet(d).schema).parquet(d)
    q = (st.coverage_stream(s).writeStream.format("memory").queryName("cov_out").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = sorted((r.stream, r.window_start, r.files) for r in spark.table("cov_out").collect())
    exp = sorted((r.stream, r.window_start, r.files) for r in coverage_windows(spark.read.parquet(d)).where("not alert").collect())
    assert got == exp
