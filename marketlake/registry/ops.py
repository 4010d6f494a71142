"""Alerts, ops, reference-data normalisation, fallback and planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions.prices import bucket_skew, bucket_symbol
from ..operators import alerts, ops, refdata
from ..operators.bars import latest_snapshot
from ..sinks.lake import export_dead_letters
from ..sources import jsonl
from . import query
from .raw import RECEIPTS_SQL, all_receipts

# ------------------------------------------------------------------ alerts


def _attr(k):
    return f"map_extract_value(attributes, '{k}')"


def _js(k):
    return f"NULLIF(json_extract_string(body_text, '$.{k}'), '')"


PARSED_ALERTS_SQL = f"""
SELECT alert_id, ts,
  CASE WHEN is_obj THEN coalesce({_js('name')}, {_attr('alert_name')}, 'unknown')
       ELSE coalesce({_attr('alert_name')}, {_attr('source')}, 'unknown') END AS name,
  CASE WHEN is_obj THEN coalesce({_js('severity')}, {_attr('severity')}, 'info')
       ELSE coalesce({_attr('severity')}, 'info') END AS severity,
  CASE WHEN is_obj THEN coalesce({_js('body')}, body_text) ELSE body_text END AS body,
  CASE WHEN is_obj THEN coalesce({_js('scope')}, {_attr('scope')}, '') ELSE coalesce({_attr('scope')}, '') END AS scope,
  CASE WHEN is_obj THEN coalesce({_js('source')}, {_attr('source')}) ELSE {_attr('source')} END AS source
FROM (SELECT *, coalesce(CASE WHEN json_valid(body_text) THEN json_type(body_text) = 'OBJECT' END, false) AS is_obj
      FROM (SELECT alert_id, ts, attributes, decode(from_base64(data)) AS body_text FROM alerts_raw))
"""
KEYED_ALERTS_SQL = f"""
SELECT alert_id, ts, severity, left(replace(name || '|' || severity || '|' || scope, '/', '_'), 1500) AS alert_key
FROM ({PARSED_ALERTS_SQL})
"""
TTL_SQL = ("CASE severity " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in schemas.ALERT_TTL_SECONDS.items())
           + f" ELSE {schemas.ALERT_TTL_DEFAULT} END")


def _parsed(lk):
    return alerts.alert_parse(lk.alerts_raw)


def _keyed(lk):
    p = _parsed(lk)
    return p.select("alert_id", "ts", "severity",
                    alerts.alert_key(F.col("name"), F.col("severity"), F.col("scope")).alias("alert_key"))


@query("alert_parse", PARSED_ALERTS_SQL)
def q_alert_parse(lk):
    return _parsed(lk)


@query("alert_key", f"SELECT alert_id, alert_key FROM ({KEYED_ALERTS_SQL})")
def q_alert_key(lk):
    return _keyed(lk).select("alert_id", "alert_key")


@query("alert_suppress", f"""
WITH RECURSIVE a AS (SELECT *, {TTL_SQL} AS ttl FROM ({KEYED_ALERTS_SQL})),
w AS (SELECT * FROM a WHERE ttl > 0),
nxt AS (SELECT p.alert_id, arg_min(n.alert_id, {{'t': n.ts, 'i': n.alert_id}}) AS next_id
        FROM (SELECT alert_id, alert_key, ts + to_seconds(ttl) AS due FROM w) p
        JOIN w n ON p.alert_key = n.alert_key AND n.ts >= p.due GROUP BY p.alert_id),
chain(alert_id) AS (
  SELECT alert_id FROM (SELECT alert_id, row_number() OVER (PARTITION BY alert_key ORDER BY ts, alert_id) AS rn FROM w)
  WHERE rn = 1
  UNION ALL
  SELECT nxt.next_id FROM chain JOIN nxt ON chain.alert_id = nxt.alert_id WHERE nxt.next_id IS NOT NULL)
SELECT a.alert_id, a.alert_key, a.ts, a.severity,
       a.ttl <= 0 OR a.alert_id IN (SELECT alert_id FROM chain) AS sent
FROM a
""")
def q_alert_suppress(lk):
    """X5 batch: which alerts are sent under per-key TTL suppression."""
    return alerts.suppress(_keyed(lk)).select("alert_id", "alert_key", "ts", "severity", "sent")


# --------------------------------------------------------------- coverage
@query("coverage", f"""
WITH r AS ({RECEIPTS_SQL}),
recent AS (SELECT stream, count(*) AS recent_files, count(DISTINCT symbol) AS unique_symbols FROM r
           WHERE max_ts >= (SELECT max(max_ts) FROM r) - INTERVAL 5 MINUTE GROUP BY stream)
SELECT s.stream, coalesce(recent_files, 0) AS recent_files, coalesce(unique_symbols, 0) AS unique_symbols,
       coalesce(recent_files, 0) = 0 AS alert
FROM (VALUES ('ticks'), ('quotes_l1'), ('quotes_l2'), ('index_values')) s(stream) LEFT JOIN recent USING (stream)
""")
def q_coverage(lk):
    """Streams with no receipt in the last 5 minutes (as of the newest receipt) stay, as zeros."""
    return ops.coverage(all_receipts(lk))


@query("coverage_5min", f"""
WITH r AS ({RECEIPTS_SQL}), b AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, max_ts) AS w FROM r),
seen AS (SELECT w, stream, count(*) AS files, count(DISTINCT symbol) AS symbols FROM b GROUP BY ALL),
every AS (SELECT w, unnest(['ticks', 'quotes_l1', 'quotes_l2', 'index_values']) AS stream FROM (SELECT DISTINCT w FROM b))
SELECT e.stream, e.w AS window_start, e.w + INTERVAL 5 MINUTE AS window_end, coalesce(files, 0) AS files,
       coalesce(symbols, 0) AS symbols, files IS NULL AS alert
FROM every e LEFT JOIN seen s ON e.w = s.w AND e.stream = s.stream
""")
def q_coverage_5min(lk):
    return ops.coverage_windows(all_receipts(lk))


# ------------------------------------------------------------ dead letters
def _dead(lk):
    return jsonl.read_dead_letters(lk.dead_letter_lines)


@query("dlq_counts", """
SELECT json_extract_string(value, '$.attributes.topic') AS topic, count(*) AS messages
FROM dead_letter_lines GROUP BY 1
""")
def q_dlq_counts(lk):
    return ops.dlq_counts(_dead(lk))


@query("export_dead_letters", """
SELECT json_extract_string(value, '$.attributes.topic') AS topic, json_extract_string(value, '$.data') AS data,
       json_extract_string(value, '$.attributes.symbol') AS symbol,
       json_extract_string(value, '$.publish_time') AS publish_time
FROM dead_letter_lines
""")
def q_export_dead_letters(lk):
    """The lines exported by topic as text files, read back and parsed."""
    root = lk.scratch("dead-letters")
    export_dead_letters(ops.export_dead_letters(_dead(lk)), root)
    d = jsonl.read_dead_letters(lk.spark.read.text(f"{root}/_ops/dead-letters").select("value"))
    return d.select(F.col("attributes")["topic"].alias("topic"), "data", F.col("attributes")["symbol"].alias("symbol"),
                    "publish_time")


@query("replay_dead_letters", """
SELECT json_extract_string(value, '$.data') AS data, json_extract_string(value, '$.attributes.topic') AS topic,
       'dead-letters/all.jsonl' AS replay_of
FROM dead_letter_lines
""")
def q_replay_dead_letters(lk):
    r = ops.replay_dead_letters(_dead(lk), "dead-letters/all.jsonl")
    return r.select("data", F.col("attributes")["topic"].alias("topic"),
                    F.col("attributes")["replay_of"].alias("replay_of"))


@query("cost_total", """
SELECT round(coalesce(sum(cost) FILTER (WHERE date BETWEEN m - 1 AND m), 0.0::DOUBLE), 6) AS daily_usd,
       round(coalesce(sum(cost) FILTER (WHERE date BETWEEN CAST(date_trunc('month', m) AS DATE) AND m), 0.0::DOUBLE), 6)
         AS monthly_usd
FROM billing, (SELECT max(date) AS m FROM billing)
""")
def q_cost_total(lk):
    return ops.cost_total(lk.billing)


# --------------------------------------------------------------- metrics
_PAIRS = [("daily_ohlcv", "daily_raw", "curated_daily"), ("ticks", "ticks_raw", "curated_ticks"),
          ("quotes_l1", "quotes_l1_raw", "curated_l1"), ("quotes_l2", "quotes_l2_raw", "curated_l2"),
          ("indices", "index_raw", "curated_index"), ("fundamentals", "fundamentals_raw", "curated_fundamentals"),
          ("corp_actions", "corp_actions_raw", "curated_corp_actions")]


@query("curate_metrics", " UNION ALL ".join(
    f"SELECT '{n}' AS stream, (SELECT count(*) FROM {r}) AS rows_in, (SELECT count(*) FROM {c}) AS rows_out, "
    f"CAST(0 AS BIGINT) AS rejected, 'ok' AS status" for n, r, c in _PAIRS))
def q_curate_metrics(lk):
    """Rows in and out of every curator, from one aggregate."""
    return ops.curate_metrics({n: (getattr(lk, r), getattr(lk, c)) for n, r, c in _PAIRS})


# ------------------------------------------------------------- reference data
@query("normalize_daily", """
SELECT CAST(time AS DATE) AS date, symbol, 'equity' AS asset_class, 'HOSE' AS exchange,
       CAST(trunc(open * 10) AS BIGINT) AS open, CAST(trunc(high * 10) AS BIGINT) AS high,
       CAST(trunc(low * 10) AS BIGINT) AS low, CAST(trunc(close * 10) AS BIGINT) AS close,
       CAST(trunc(volume) AS BIGINT) AS volume,
       CAST(trunc(close * 10) AS BIGINT) * CAST(trunc(volume) AS BIGINT) AS value,
       NULL::BIGINT AS foreign_buy_vol, NULL::BIGINT AS foreign_sell_vol
FROM vendor_daily
""")
def q_normalize_daily(lk):
    return refdata.normalize_daily(lk.vendor_daily)


@query("normalize_fundamentals", """
SELECT report_date AS as_of_date, symbol, CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS period,
       pe, pb, eps, NULL::DOUBLE AS bvps, NULL::DOUBLE AS roe, NULL::DOUBLE AS roa, NULL::DOUBLE AS debt_to_equity,
       NULL::BIGINT AS market_cap, NULL::BIGINT AS revenue, NULL::BIGINT AS net_income,
       NULL::BIGINT AS total_assets, NULL::BIGINT AS total_equity
FROM vendor_fundamentals
""")
def q_normalize_fundamentals(lk):
    return refdata.normalize_fundamentals(lk.vendor_fundamentals)


@query("normalize_corp_actions", """
SELECT exDate AS ex_date, record_date, NULL::DATE AS payment_date, symbol, action_type, ratio, amount
FROM vendor_corp_actions
""")
def q_normalize_corp_actions(lk):
    return refdata.normalize_corp_actions(lk.vendor_corp_actions)


@query("normalize_tickers", """
SELECT symbol, name, NULL::VARCHAR AS exchange, NULL::VARCHAR AS asset_class, NULL::VARCHAR AS sector_l1,
       NULL::VARCHAR AS sector_l2, NULL::VARCHAR AS industry, NULL::VARCHAR AS status,
       CAST(TRY_STRPTIME(listed_date, '%Y-%m-%d') AS DATE) AS listed_date, lot_size,
       NULL::BIGINT AS tick_size, NULL::DOUBLE AS foreign_room_pct
FROM vendor_tickers
""")
def q_normalize_tickers(lk):
    return refdata.normalize_tickers(lk.vendor_tickers)


@query("normalize_futures", """
SELECT symbol, underlying_index, CAST(TRY_STRPTIME(expiry_date, '%Y-%m-%d') AS DATE) AS expiry_date,
       contract_size, NULL::BIGINT AS tick_size, NULL::DOUBLE AS margin_pct
FROM vendor_futures
""")
def q_normalize_futures(lk):
    return refdata.normalize_futures(lk.vendor_futures)


SOURCE_PRIORITY_SQL = """
SELECT b.symbol, p.source, CASE WHEN b.r IS NULL THEN 'all_sources_failed' ELSE 'ok' END AS status
FROM (SELECT symbol, min(CASE WHEN status = 'ok' THEN rank END) AS r FROM pull_results GROUP BY symbol) b
LEFT JOIN pull_results p ON b.symbol = p.symbol AND b.r = p.rank
"""


@query("source_priority", SOURCE_PRIORITY_SQL)
def q_source_priority(lk):
    return refdata.source_priority(lk.pull_results)


@query("forward_actions", """
SELECT * FROM curated_corp_actions
WHERE ex_date BETWEEN (SELECT max(ex_date) FROM curated_corp_actions) - 30 AND (SELECT max(ex_date) FROM curated_corp_actions)
""")
def q_forward_actions(lk):
    """The 30-day forward window of the final daily sweep."""
    a = lk.curated_corp_actions
    last = a.agg(F.max("ex_date")).first()[0]
    import datetime as dt
    return refdata.forward_actions(a, last - dt.timedelta(days=30))


@query("quarterly_report_dates", "SELECT DISTINCT date, (" + " OR ".join(
    f"(month(date) = {m} AND abs(day(date) - {d}) <= {schemas.QUARTERLY_WINDOW_DAYS})"
    for m, d in schemas.QUARTERLY_REPORT_DATES.values()) + ") AS is_report_date FROM curated_daily")
def q_quarterly_report_dates(lk):
    return lk.curated_daily.select("date").distinct().select(
        "date", refdata.is_quarterly_report_date("date").alias("is_report_date"))


CHUNKS_SQL = """
SELECT chunk, min(d) AS start, max(d) AS "end" FROM (
  SELECT CAST(ntile(10) OVER (ORDER BY d) AS INTEGER) AS chunk, d FROM (
    SELECT CAST(x AS DATE) AS d FROM (SELECT unnest(generate_series(CAST(min(date) AS TIMESTAMP),
        CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS x FROM curated_daily)))
GROUP BY chunk
"""


def _chunks(lk):
    return refdata.plan_chunks(lk.curated_daily, 10)


@query("plan_chunks", CHUNKS_SQL)
def q_plan_chunks(lk):
    """The bars' whole date range split for 10 backfill tasks."""
    return _chunks(lk)


@query("gate_fundamentals_by_chunk", f"""
SELECT c.chunk, f.symbol, f.period, f.as_of_date FROM curated_fundamentals f
JOIN ({CHUNKS_SQL}) c ON f.as_of_date BETWEEN c.start AND c."end"
""")
def q_gate_fundamentals_by_chunk(lk):
    f = lk.curated_fundamentals.select("symbol", "period", "as_of_date")
    return refdata.gate_by_chunk(f, _chunks(lk), "as_of_date").select("chunk", "symbol", "period", "as_of_date")


_TICKERS_NOW = "SELECT symbol FROM tickers WHERE snapshot = (SELECT max(snapshot) FROM tickers)"


@query("bucket_symbols", f"""
SELECT symbol, CASE WHEN symbol IN ({", ".join(f"'{x}'" for x in schemas.PINNED_SYMBOLS)}) THEN 0
            ELSE CAST(('0x' || substr(md5(symbol), 1, 8))::BIGINT % 4 AS INTEGER) END AS bucket
FROM ({_TICKERS_NOW} UNION ALL SELECT unnest([{", ".join(f"'{x}'" for x in schemas.PINNED_SYMBOLS)}]))
""")
def q_bucket_symbols(lk):
    """Shard of every listed symbol and index; indices are pinned to shard 0."""
    t = latest_snapshot(lk.tickers).select("symbol")
    pinned = lk.spark.createDataFrame([(x,) for x in schemas.PINNED_SYMBOLS], "symbol string")
    return t.unionByName(pinned).select("symbol", bucket_symbol(F.col("symbol"), 4, schemas.PINNED_SYMBOLS).alias("bucket"))


@query("bucket_skew", f"""
WITH b AS (SELECT CAST(('0x' || substr(md5(symbol), 1, 8))::BIGINT % 4 AS INTEGER) AS bucket FROM ({_TICKERS_NOW}))
SELECT bucket, count(*) AS symbols, count(*) * 4.0::DOUBLE / (SELECT count(*) FROM b) AS of_mean FROM b GROUP BY bucket
""")
def q_bucket_skew(lk):
    """Symbols per shard against the mean."""
    return bucket_skew(latest_snapshot(lk.tickers).select("symbol"), 4)


@query("eod_summary", f"""
WITH failed AS (SELECT list_sort(list(symbol || ': ' || status)) AS names FROM ({SOURCE_PRIORITY_SQL}) WHERE status <> 'ok')
SELECT 'daily_ohlcv' AS stream, (SELECT count(*) FROM curated_daily) AS rows,
       (SELECT array_to_string(names, '; ') FROM failed) AS errors
UNION ALL SELECT 'fundamentals', (SELECT count(*) FROM curated_fundamentals), NULL
UNION ALL SELECT 'corp_actions', (SELECT count(*) FROM curated_corp_actions), NULL
""")
def q_eod_summary(lk):
    """Rows per stream, and the list of symbols no source could serve."""
    failed = refdata.source_priority(lk.pull_results).where(F.col("status") != "ok")
    return ops.run_summary({"daily_ohlcv": lk.curated_daily, "fundamentals": lk.curated_fundamentals,
                            "corp_actions": lk.curated_corp_actions},
                           failed.select(F.lit("daily_ohlcv").alias("stream"), F.concat_ws(": ", "symbol", "status").alias("error")))


@query("backfill_summary", f"""
WITH c AS ({CHUNKS_SQL}), failed AS (
  SELECT 'daily_ohlcv' AS stream, array_to_string(list_sort(list(symbol || ': ' || status)), '; ') AS errors
  FROM ({SOURCE_PRIORITY_SQL}) WHERE status <> 'ok'),
counted AS (
SELECT c.chunk, 'daily_ohlcv' AS stream, count(d.date) AS rows FROM c LEFT JOIN curated_daily d
  ON d.date BETWEEN c.start AND c."end" GROUP BY c.chunk
UNION ALL
SELECT c.chunk, 'corp_actions', count(a.ex_date) FROM c LEFT JOIN curated_corp_actions a
  ON a.ex_date BETWEEN c.start AND c."end" GROUP BY c.chunk)
SELECT chunk, counted.stream, rows, errors FROM counted LEFT JOIN failed USING (stream)
""")
def q_backfill_summary(lk):
    """Rows landed per backfill chunk and stream, with the stream's errors."""
    ch = _chunks(lk)
    d = refdata.gate_by_chunk(lk.curated_daily.select("date"), ch, "date").groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"))
    a = refdata.gate_by_chunk(lk.curated_corp_actions.select("ex_date"), ch, "ex_date").groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"))
    failed = refdata.source_priority(lk.pull_results).where(F.col("status") != "ok")
    errors = ops.error_lists(failed.select(F.lit("daily_ohlcv").alias("stream"),
                                           F.concat_ws(": ", "symbol", "status").alias("error")))

    def full(x, name):
        return (ch.select("chunk").join(x, "chunk", "left")
                .select("chunk", F.lit(name).alias("stream"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))
    return full(d, "daily_ohlcv").unionByName(full(a, "corp_actions")).join(errors, "stream", "left").select(
        "chunk", "stream", "rows", "errors")
