"""Structured Streaming jobs (X1-X4, X6); operators with timers are in state.py.

The source is any stream of (msg_id, channel, payload, ts_received): JSON
files in tests, a message bus in production (same columns by configuration).
Each micro-batch is routed, parsed, validated and landed by the batch
operators, so streaming and nightly batch share one definition.  The
checkpoint replaces the reference's in-memory flush buffer: nothing is
acknowledged before it is written.

Delivery: every micro-batch writes under its own batch directory and
replaces it when it is run again after a failure, so rows, rejects and receipts are
landed exactly once.  Messages that the source itself delivers twice are settled by
curation, which keeps one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest
from ..sinks import lake as sink

MESSAGE_SCHEMA = "msg_id long, channel string, payload string, ts_received timestamp"

#: A flush: at most so much input a micro-batch, at least one a minute.
FLUSH_BYTES, FLUSH_INTERVAL = 50 << 20, "60 seconds"


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Messages as they arrive, at most `max_files_per_trigger` files or `max_bytes_per_trigger` (FLUSH_BYTES unless
    either is given) a micro-batch."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger or FLUSH_BYTES)
    return r.json(path)


def land_batch(batch: DataFrame, root: str, epoch: int | str) -> dict:
    """X1 + X3 for one micro-batch: every message is decoded once; accepted rows, rejects, parse errors and receipts
    are written from that.  Landing the same `epoch` again replaces what it wrote before."""
    r = ingest.routed(batch)
    r.tagged.persist()
    try:
        counts = {x["stream"]: x for x in r.counts().collect()}  # one row per stream
        for stream in ingest.STREAMS:
            if stream not in counts:
                continue
            rows = r.rows(stream).withColumn("date", F.to_date("ts_event"))
            ok, bad = ingest.split_rejects(rows)
            if counts[stream]["accepted"]:
                sink.land_stream(ok.withColumnRenamed("msg_id", "ingest_seq"), root, stream, epoch)
            if counts[stream]["rejected"]:
                sink.quarantine(bad, root, stream, epoch)
        sink.write_receipts(r.receipts(str(epoch)), root, epoch)
        sink.quarantine_parse_errors(r.errors(), root, epoch)
    finally:
        r.tagged.unpersist()
    return {s: counts[s]["accepted"] if s in counts else 0 for s in ingest.STREAMS}


def start_ingest(spark: SparkSession, source: str, root: str, checkpoint: str,
                 available_now: bool = False, interval: str = FLUSH_INTERVAL,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Continuous landing.  A micro-batch is flushed every `interval` and bounded by bytes (FLUSH_BYTES) or,
    if given, by files; `available_now` drains what exists and stops."""
    w = (message_stream(spark, source, max_files_per_trigger, max_bytes_per_trigger).writeStream
         .foreachBatch(lambda df, epoch: land_batch(df, root, epoch))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def drain(query: StreamingQuery, spark: SparkSession, source: str, root: str, checkpoint: str) -> None:
    """Stop an ingest and flush all that has arrived by a last run over the same checkpoint.  A micro-batch that the
    stop has cut short is landed again under its own batch; nothing is acknowledged that was not written."""
    query.stop()
    start_ingest(spark, source, root, checkpoint, available_now=True).awaitTermination()


def dedup_stream(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streaming dedup of ticks within the watermark.  Rows later than the
    watermark are dropped here; the nightly batch curation keeps them."""
    return (ticks.withWatermark("ts_event", delay)
            .dropDuplicatesWithinWatermark(["symbol", "ts_event", "trade_id"]))


def coverage_stream(receipts: DataFrame, minutes: int = 5, delay: str = "10 minutes") -> DataFrame:
    """Receipts per stream per 5-minute window of newest-row time, with a watermark."""
    w = F.window("max_ts", f"{minutes} minutes")
    return (receipts.withWatermark("max_ts", delay).groupBy("stream", w.alias("w"))
            .agg(F.count(F.lit(1)).alias("files"))
            .select("stream", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "files"))
