"""The five jobs (L1-L5) over a lake root.  Every step is a Spark job; the
driver only sequences them and reads back small metrics.  A step that fails is recorded
and the others still run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import calendar as cal
from ..operators import curate, quality, refdata
from ..operators.adjust import action_factors
from ..session import configure
from ..sinks import commits
from ..sinks import lake as sink
from ..sources import lake as src
from . import daily

CURATORS = {
    "ticks": curate.curate_ticks,
    "quotes_l1": curate.curate_quotes_l1,
    "quotes_l2": curate.curate_quotes_l2,
    "index_values": curate.curate_indices,
    "fundamentals": curate.curate_fundamentals,
    "corp_actions": curate.curate_corp_actions,
    "tickers": curate.curate_tickers,
    "futures_contracts": curate.curate_futures,
}
# pulled tables: vendor columns -> entity, and the sink that lands it
PULLED = {
    "daily_ohlcv": (refdata.normalize_daily, sink.land_daily),
    "fundamentals": (refdata.normalize_fundamentals, sink.land_fundamentals),
    "corp_actions": (refdata.normalize_corp_actions, sink.land_corp_actions),
}


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    ob = Observation(name)
    return df.observe(ob, F.count(F.lit(1)).alias("rows")), ob


def _rows(ob: Observation) -> int:
    """Rows counted by a job that has succeeded; an input known to be empty is folded away together
    with its observation, which then has no value."""
    try:
        return ob.get["rows"]
    except Exception:  # noqa: BLE001
        return 0


def _rejected(spark: SparkSession, root: str, stream: str, date: str | None) -> int:
    path = f"{root}/_ops/rejected/{stream}"
    if not sink.path_exists(spark, path):
        return 0
    bad = spark.read.parquet(path)
    return (bad if date is None else bad.where(F.col("date") == F.lit(date).cast("date"))).count()


def run_curate(spark: SparkSession, root: str, stream: str, date: str | None = None, full: bool = False) -> dict:
    """L2: scan -> curate -> dynamic overwrite -> metrics, counted in the same pass.
    Daily bars are curated by what has changed (plans/daily.py) unless `full`.
    `rejected` counts the stream's quarantined rows; a failure is told in `status`."""
    configure(spark)
    out = {"stream": stream, "date": date, "rows_in": 0, "rows_out": 0, "rejected": 0, "status": "ok"}
    try:
        if stream == "daily_ohlcv":
            return out | daily.curate_daily(spark, root, date, full) | {"rejected": _rejected(spark, root, stream, date)}
        raw, ob_in = _observed(src.scan_raw(spark, root, stream, date), "in")
        curated = CURATORS[stream](raw)
        if stream == "fundamentals":
            curated = curated.withColumn("quarter", F.col("period"))
        if stream == "corp_actions":
            curated = curated.withColumn("year", F.year("ex_date"))
        curated, ob_out = _observed(curated, "out")
        sink.write_curated(curated, root, stream)
        out |= {"rows_in": _rows(ob_in), "rows_out": _rows(ob_out),
                "rejected": _rejected(spark, root, stream, date)}
    except Exception as e:  # noqa: BLE001 - one stream must not stop the others
        out["status"] = f"failed: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    return out


def is_trading_day(spark: SparkSession, calendar: cal.Calendar, on: dt.date) -> bool:
    """Calendar gate (J8) for one run date."""
    probe = spark.createDataFrame([(on,)], "date date")
    return bool(cal.trading_day_flags(probe, calendar).first()["is_trading_day"])


def _land(name: str, pull: Callable[[], DataFrame] | DataFrame, root: str, keep, errors: list[dict]) -> int:
    """Normalise and land one pulled table; rows landed, or 0 and an entry in `errors`."""
    normalise, land = PULLED[name]
    try:
        rows = normalise(pull() if callable(pull) else pull)
        rows = sink.staged(rows.where(keep) if keep is not None else rows, name)
        land(rows, root)
        return rows.count()
    except Exception as e:  # noqa: BLE001
        errors.append({"stream": name, "error": f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"})
        return 0


def run_eod(spark: SparkSession, root: str, on: dt.date, calendar: cal.Calendar, pulls: dict | None = None,
            streams=("ticks", "quotes_l1", "quotes_l2", "index_values")) -> dict:
    """L1: gate on the calendar; land the day's bars, fundamentals on filing dates and the forward
    window of actions; curate; sum up (G16).

    `pulls` maps daily_ohlcv, fundamentals and corp_actions to vendor frames or callables; the summary
    has the rows landed, every curated stream's metrics and the list of errors."""
    configure(spark)
    out = {"date": str(on), "status": "ok", "landed": {}, "curated": [], "errors": []}
    if not is_trading_day(spark, calendar, on):
        return out | {"status": "skipped: not a trading day"}
    day = F.lit(str(on)).cast("date")
    probe = spark.createDataFrame([(on,)], "date date").select(refdata.is_quarterly_report_date("date").alias("q"))
    wanted = {"daily_ohlcv": F.col("date") == day,
              "corp_actions": F.col("ex_date").between(day, F.date_add(day, refdata.schemas.FORWARD_ACTION_DAYS))}
    if probe.first()["q"]:
        wanted["fundamentals"] = None
    for name, pull in (pulls or {}).items():
        if name in wanted:
            out["landed"][name] = _land(name, pull, root, wanted[name], out["errors"])
    for s in (*streams, "daily_ohlcv"):
        m = run_curate(spark, root, s, str(on) if s != "daily_ohlcv" else None)
        out["curated"].append(m)
        if m["status"] != "ok":
            out["errors"].append({"stream": s, "error": m["status"]})
    out["status"] = "ok" if not out["errors"] else "errors"
    return out


def run_backfill(spark: SparkSession, root: str, vendor_daily: DataFrame, start: str, end: str,
                 num_tasks: int, unavailable=("ticks", "quotes_l1"), fundamentals: DataFrame | None = None,
                 corp_actions: DataFrame | None = None, reference: dict[str, DataFrame] | None = None) -> DataFrame:
    """L3: plan chunks (W6), skip the (symbol, day) pairs already landed (M8), land vendor bars for the
    rest in one write (S9) and the other tables by key (S10-S12), record gaps for streams
    with no history source (S6).  Returns (stream, chunk, start, end, rows, errors) (G17);
    tables that are not chunked have a null chunk."""
    configure(spark)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    bars = refdata.normalize_daily(vendor_daily).where(F.col("date").between(lo, hi))
    chunks = refdata.plan_chunks(bars.select("date").distinct(), num_tasks)
    landed = f"{root}/raw/daily_ohlcv_backfill"
    errors: list[dict] = []
    counted = None
    try:
        if sink.path_exists(spark, landed):
            present = commits.read(spark, landed).select("symbol", "date").distinct()
            bars = bars.join(present, ["symbol", "date"], "left_anti")
        tagged = sink.staged(refdata.gate_by_chunk(bars, chunks, "date"), "backfill")
        counted = tagged.groupBy("chunk").agg(F.count(F.lit(1)).alias("rows"))
        sink.land_backfill(tagged.drop("chunk"), root)
    except Exception as e:  # noqa: BLE001
        errors.append({"stream": "daily_ohlcv", "error": f"{type(e).__name__}: {str(e).splitlines()[0]}"})
    rows = {}
    for name, frame, keep in (("fundamentals", fundamentals, F.col("as_of_date").between(lo, hi)),
                              ("corp_actions", corp_actions, F.col("ex_date").between(lo, hi))):
        if frame is not None:
            rows[name] = _land(name, frame, root, keep, errors)
    for name, frame in (reference or {}).items():
        try:
            counts = _land_reference(frame, root, name, end)
            rows[name] = counts
        except Exception as e:  # noqa: BLE001
            rows[name] = 0
            errors.append({"stream": name, "error": f"{type(e).__name__}: {str(e).splitlines()[0]}"})
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    gaps = spark.createDataFrame([(s, start, end, "no historical source", now) for s in unavailable],
                                 "stream string, start string, end string, reason string, recorded_at string")
    for s in unavailable:
        sink.record_gaps(gaps.where(F.col("stream") == s), root, s, f"backfill-{start}-{end}")
    failed = {e["stream"]: e["error"] for e in errors}
    daily = chunks.select(F.lit("daily_ohlcv").alias("stream"), "chunk", "start", "end")
    daily = (daily.join(counted, "chunk", "left") if counted is not None else daily.withColumn("rows", F.lit(0))).select(
        "stream", "chunk", "start", "end", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.lit(failed.get("daily_ohlcv")).cast("string").alias("errors"))
    rest = spark.createDataFrame(
        [(n, None, dt.date.fromisoformat(start), dt.date.fromisoformat(end), r, failed.get(n)) for n, r in rows.items()], daily.schema)
    return daily.unionByName(rest)


REFERENCE = {"tickers": refdata.normalize_tickers, "futures_contracts": refdata.normalize_futures}


def _land_reference(vendor: DataFrame, root: str, table: str, snapshot: str) -> int:
    rows = sink.staged(REFERENCE[table](vendor).withColumn("snapshot", F.lit(snapshot).cast("date")), table)
    sink.land_reference(rows, root, table)
    return rows.count()


def run_reference(spark: SparkSession, root: str, vendor_tickers: DataFrame, vendor_futures: DataFrame,
                  snapshot: str) -> dict:
    """L4: normalise and land both reference tables under one snapshot (S12); rows of each, and the list of errors."""
    configure(spark)
    out: dict = {"errors": []}
    for table, vendor in (("tickers", vendor_tickers), ("futures_contracts", vendor_futures)):
        try:
            out[table] = _land_reference(vendor, root, table, snapshot)
        except Exception as e:  # noqa: BLE001 - one table must not stop the other
            out[table] = 0
            out["errors"].append({"stream": table, "error": f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"})
    return out


def run_dq(spark: SparkSession, root: str, calendar: cal.Calendar) -> DataFrame:
    """The validators over the curated tables and their summary (G13).  Each reads its own
    tables, so a missing or broken one fails its validators only (-1)."""
    configure(spark)

    def table(name: str) -> DataFrame:
        return src.scan_curated(spark, root, name)

    def factors() -> DataFrame:
        return action_factors(table("corp_actions").withColumn("ingest_seq", F.lit(0)), table("daily_ohlcv"))
    return quality.dq_summary({
        "tick_vs_daily": lambda: quality.tick_vs_daily(table("ticks"), table("daily_ohlcv"), days=7),
        "l1_vs_l2": lambda: quality.l1_vs_l2(table("quotes_l1"), table("quotes_l2")),
        "corp_actions_applied": lambda: quality.corp_actions_applied(table("daily_ohlcv"), table("corp_actions"), days=30),
        "corp_actions_applied_fixed": lambda: quality.corp_actions_applied_fixed(table("daily_ohlcv"), factors(), days=30),
        "missing_days": lambda: cal.missing_days(table("daily_ohlcv"), calendar),
    })
