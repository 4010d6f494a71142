"""Ops queries: ingest coverage (J10, X6), dead letters (S7, S8, G14), cost (G15),
run summaries (S13, G16, G17)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

STREAMS = schemas.STREAMS


def stream_list(spark: SparkSession, streams=STREAMS) -> DataFrame:
    return spark.createDataFrame([(s,) for s in streams], "stream string")


def coverage(receipts: DataFrame, as_of=None, minutes: int = 5, streams=STREAMS) -> DataFrame:
    """Receipts whose newest row is within `minutes` of `as_of`, per stream;
    streams with none are kept with zeros and flagged (J10)."""
    if as_of is None:
        as_of = receipts.agg(F.max("max_ts")).first()[0]
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    recent = (receipts.where(F.col("max_ts") >= cutoff).groupBy("stream")
              .agg(F.count(F.lit(1)).alias("recent_files"), F.count_distinct("symbol").alias("unique_symbols")))
    out = stream_list(receipts.sparkSession, streams).join(recent, "stream", "left")
    return out.select("stream", F.coalesce("recent_files", F.lit(0)).alias("recent_files"),
                      F.coalesce("unique_symbols", F.lit(0)).alias("unique_symbols")).withColumn(
        "alert", F.col("recent_files") == 0)


def coverage_windows(receipts: DataFrame, minutes: int = 5, streams=STREAMS) -> DataFrame:
    """Receipts and symbols per stream per tumbling window of newest-row time (X6, batch form).
    In a window in which any stream has receipts, the silent ones stay as zeros and alert."""
    w = F.window("max_ts", f"{minutes} minutes")
    seen = (receipts.groupBy(w.alias("w"), "stream")
            .agg(F.count(F.lit(1)).alias("files"), F.count_distinct("symbol").alias("symbols")))
    every = seen.select("w").distinct().withColumn("stream", F.explode(F.array(*[F.lit(s) for s in streams])))
    out = every.join(seen, ["w", "stream"], "left")
    return out.select("stream", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("symbols", F.lit(0)).alias("symbols"),
                      F.col("files").isNull().alias("alert"))


def dlq_counts(dead: DataFrame) -> DataFrame:
    """Messages per topic."""
    return dead.groupBy(F.col("attributes")["topic"].alias("topic")).agg(F.count(F.lit(1)).alias("messages"))


def export_dead_letters(dead: DataFrame) -> DataFrame:
    """One JSON line per message, keyed by topic for a partitioned text write."""
    return dead.select(F.col("attributes")["topic"].alias("topic"),
                       F.to_json(F.struct("data", "attributes", "publish_time")).alias("value"))


def replay_dead_letters(dead: DataFrame, source_uri: str) -> DataFrame:
    """Messages to re-publish, with attribute replay_of = source_uri."""
    kept = F.map_filter("attributes", lambda k, v: k != F.lit("replay_of"))
    attrs = F.map_concat(kept, F.create_map(F.lit("replay_of"), F.lit(source_uri)))
    return dead.select("data", attrs.alias("attributes"))


def cost_total(billing: DataFrame, as_of=None) -> DataFrame:
    """Cost over yesterday..today and month-to-date; 0 when nothing matches."""
    if as_of is None:
        as_of = billing.agg(F.max("date")).first()[0]
    day0 = as_of - dt.timedelta(days=1)
    month0 = as_of.replace(day=1)
    d = F.col("date")
    a = F.lit(str(as_of)).cast("date")
    return billing.agg(
        F.coalesce(F.sum(F.when(d.between(F.lit(str(day0)).cast("date"), a), F.col("cost"))), F.lit(0.0)).alias("daily"),
        F.coalesce(F.sum(F.when(d.between(F.lit(str(month0)).cast("date"), a), F.col("cost"))), F.lit(0.0)).alias("monthly"),
    ).select(F.round("daily", 6).alias("daily_usd"), F.round("monthly", 6).alias("monthly_usd"))


def curate_metrics(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """rows_in, rows_out, rejected, status per curated stream (S13): one
    aggregate over the tagged union of every input and output."""
    parts = []
    for name, (raw, cur) in pairs.items():
        parts.append(raw.select(F.lit(name).alias("stream"), F.lit(1).alias("_in"), F.lit(0).alias("_out")))
        parts.append(cur.select(F.lit(name).alias("stream"), F.lit(0).alias("_in"), F.lit(1).alias("_out")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("stream").agg(F.sum("_in").cast("long").alias("rows_in"),
                                   F.sum("_out").cast("long").alias("rows_out")).select(
        "stream", "rows_in", "rows_out", F.lit(0).cast("long").alias("rejected"), F.lit("ok").alias("status"))


def error_lists(errors: DataFrame) -> DataFrame:
    """(stream, error) rows -> one sorted list of errors per stream, as text.  One entry per failed symbol."""
    return errors.groupBy("stream").agg(F.array_join(F.sort_array(F.collect_list("error")), "; ").alias("errors"))


def run_summary(landed: dict[str, DataFrame], errors: DataFrame) -> DataFrame:
    """Rows per stream and the list of its errors, null without any."""
    counts = None
    for name, df in landed.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stream"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(error_lists(errors), "stream", "left").select("stream", "rows", "errors")
