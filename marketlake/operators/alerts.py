"""Alerts: parse (P14), key (P16), suppression windows (X5, batch form).

Suppression rule, per key in time order: an alert is sent when no window is
open; a sent alert opens a window of TTL(severity); suppressed alerts do not
extend it; at exactly the expiry the next alert is sent; critical is never
suppressed.  So within a key the sent alerts form a chain
    s1 = first alert,  s(k+1) = first alert with ts >= s(k) + ttl.

A per-key sorted scan would put a hot key in one task.  Instead every alert
gets its successor `next(i)` by a bucketed forward as-of join (skew-safe),
and the chain is found by pointer doubling: round k follows 2^k hops at
once, each round a join on unique alert ids cut from the previous lineage by
a checkpoint.  The doubling starts from every *anchor* -- an alert whose gap
to the previous alert of its key is at least the TTL, which no window can
cover, so it is always sent and lies on the chain.  Rounds are then
log2(longest run between anchors), not log2(alerts per key).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import checkpoint_dir
from .asof import asof_backward


def ttl_seconds(severity: Column) -> Column:
    out = None
    for sev, secs in schemas.ALERT_TTL_SECONDS.items():
        out = F.when(severity == sev, F.lit(secs)) if out is None else out.when(severity == sev, F.lit(secs))
    return out.otherwise(F.lit(schemas.ALERT_TTL_DEFAULT))


def alert_parse(raw: DataFrame, data: str = "data", attrs: str = "attributes") -> DataFrame:
    """base64 body -> name, severity, body, scope, source.

    A JSON object body supplies the fields, with message attributes filling
    blanks; a plain-text body takes every field from the attributes.  Bodies
    that are not valid base64 are dropped (the reference rejects them).
    """
    body = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    keep = [c for c in raw.columns if c not in (data, attrs)]
    # one-row generators: the decoded body and its parse are computed once per
    # alert instead of being inlined into every output column below
    x = (raw.select(*keep, attrs, F.inline(F.array(F.struct(body.alias("body_text")))))
         .where(F.col("body_text").isNotNull()))
    is_obj = F.trim("body_text").startswith("{") & F.get_json_object("body_text", "$").isNotNull()
    x = x.select(*keep, attrs, "body_text",
                 F.inline(F.array(F.struct(is_obj.alias("_obj"),
                                           F.from_json("body_text", schemas.ALERT_BODY).alias("_p")))))
    p = F.col("_p")
    a = F.col(attrs)

    def ne(c):
        return F.nullif(c, F.lit(""))

    def pick(obj_val, plain_val):
        return F.when(F.col("_obj"), obj_val).otherwise(plain_val)

    return x.select(
        *keep,
        pick(F.coalesce(ne(p["name"]), a["alert_name"], F.lit("unknown")),
             F.coalesce(a["alert_name"], a["source"], F.lit("unknown"))).alias("name"),
        pick(F.coalesce(ne(p["severity"]), a["severity"], F.lit("info")),
             F.coalesce(a["severity"], F.lit("info"))).alias("severity"),
        pick(F.coalesce(ne(p["body"]), F.col("body_text")), F.col("body_text")).alias("body"),
        pick(F.coalesce(ne(p["scope"]), a["scope"], F.lit("")), F.coalesce(a["scope"], F.lit(""))).alias("scope"),
        pick(F.coalesce(ne(p["source"]), a["source"]), a["source"]).alias("source"),
    )


def alert_key(name: Column, severity: Column, scope: Column) -> Column:
    """name|severity|scope with '/' -> '_', cut to 1500 characters."""
    k = F.concat_ws("|", name, severity, scope)
    return F.substring(F.replace(k, F.lit("/"), F.lit("_")), 1, schemas.ALERT_KEY_MAX)


def suppress(alerts: DataFrame, id_col: str = "alert_id", key: str = "alert_key", ts: str = "ts",
             severity: str = "severity", max_rounds: int = 64, stats: dict | None = None) -> DataFrame:
    """Add `sent` (bool) to every alert following the suppression rule.
    `stats`, when given, receives the anchor count, rounds and timings."""
    t0 = time.perf_counter()
    spark = alerts.sparkSession
    checkpoint_dir(spark)
    a = alerts.withColumn("_ttl", ttl_seconds(F.col(severity)))
    # materialised once: every round below re-reads it
    windowed = a.where(F.col("_ttl") > 0).select(id_col, key, ts, "_ttl").checkpoint()
    probes = windowed.select(key, F.col(id_col).alias("node"),
                             F.timestamp_add("SECOND", F.col("_ttl"), F.col(ts)).alias("_due"))
    targets = windowed.select(key, F.col(ts).alias("_t"), F.col(id_col).alias("jump"))
    edges = asof_backward(probes, targets, by=[key], left_key="_due", right_key="_t", values=["jump"],
                          strict=False, forward=True, right_order=["jump"],
                          bucket=lambda c: F.date_trunc("HOUR", c)).select("node", "jump")
    edges = edges.checkpoint()
    if stats is not None:
        stats["input_and_edges_s"] = round(time.perf_counter() - t0, 2)
    # anchors: first alert at its timestamp, and nothing earlier within the TTL
    prev = asof_backward(windowed.select(key, id_col, ts, "_ttl"),
                         windowed.select(key, F.col(ts).alias("_pt")), by=[key], left_key=ts, right_key="_pt",
                         values=["_pt"], strict=True, bucket=lambda c: F.date_trunc("HOUR", c))
    first_at_ts = windowed.groupBy(key, ts).agg(F.min(id_col).alias("node"))
    anchors = (prev.join(first_at_ts, [key, ts])
               .where(F.col(id_col) == F.col("node"))
               .where(F.col("_pt").isNull()
                      | (F.col("_pt") <= F.timestamp_add("SECOND", -F.col("_ttl"), F.col(ts)))))
    # one table per round: every alert's current jump (2^k hops) and whether
    # the chain has reached it; a round doubles the jumps and pushes `reached`
    # along the current jumps, in one checkpointed job
    t = (edges.join(anchors.select("node", F.lit(True).alias("_a")), "node", "left")
         .select("node", "jump", F.coalesce("_a", F.lit(False)).alias("reached")).checkpoint())
    n = t.where("reached").count()
    if stats is not None:
        stats["anchors"] = n
        stats["setup_s"] = round(time.perf_counter() - t0, 2)
    for rnd in range(max_rounds):
        hit = (t.where(F.col("reached") & F.col("jump").isNotNull())
               .select(F.col("jump").alias("node")).distinct().withColumn("_hit", F.lit(True)))
        t1, t2 = t.alias("t1"), t.alias("t2")
        doubled = (t1.join(t2, F.col("t1.jump") == F.col("t2.node"), "left")
                   .select(F.col("t1.node").alias("node"), F.col("t2.jump").alias("jump"),
                           F.col("t1.reached").alias("reached")))
        nxt = (doubled.join(hit, "node", "left")
               .select("node", "jump", (F.col("reached") | F.coalesce("_hit", F.lit(False))).alias("reached"))
               .checkpoint())
        m = nxt.where("reached").count()
        if m == n:
            if stats is not None:
                stats["rounds"] = rnd + 1
                stats["total_s"] = round(time.perf_counter() - t0, 2)
            break
        t, n = nxt, m
    else:
        raise RuntimeError("suppression chain did not converge")
    reached = t.where("reached").select("node")
    sent_ids = reached.select(F.col("node").alias("_sid"), F.lit(True).alias("_sent"))
    out = a.join(sent_ids, F.col(id_col) == F.col("_sid"), "left")
    return out.withColumn("sent", (F.col("_ttl") <= 0) | F.coalesce(F.col("_sent"), F.lit(False))).drop(
        "_sid", "_sent", "_ttl")
