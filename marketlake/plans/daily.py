"""L2 for daily bars: curation by what has changed since the last run.

State under `_ops/curate-state/daily_ohlcv/version=N/`: `days` holds a fingerprint of the raw files of each
landed day, `factors` the factor of every action.  A run lists the raw files, reads the days whose files differ,
finds the symbols whose factors differ, and rewrites only the years that hold their earlier bars or a changed
bar.  State is written after the bars under a new version, so a run that dies in between is
repeated from the old one with the same result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import curate, incremental
from ..operators.dedup import dedup_first
from ..sinks import commits
from ..sinks import lake as sink
from ..sources import lake as src

KEEP_VERSIONS = 2


def raw_days(spark: SparkSession, root: str) -> DataFrame:
    """(date, files): a fingerprint of the files that hold each landed day's bars, from their listing alone."""
    parts = [p for p in (f"{root}/raw/{s}" for s in src.DAILY_LAYOUTS) if sink.path_exists(spark, p)]
    if not parts:
        raise FileNotFoundError(f"no daily bars under {root}/raw")
    # the content column is not selected, so no file is opened
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(
        [x for p in parts for x in commits.live_folders(spark, p)])
    day = F.regexp_extract("path", "/date=([0-9-]+)/", 1).try_cast("date")
    return files.select(day.alias("date"), F.xxhash64("path", "modificationTime", "length").alias("h")).where("date is not null").groupBy(
        "date").agg(F.xxhash64(F.array_sort(F.collect_list("h"))).alias("files"))


def _state_dir(root: str) -> str:
    return f"{root}/_ops/curate-state/daily_ohlcv"


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of the state, ascending."""
    base = _state_dir(root)
    if not sink.path_exists(spark, base):
        return []
    names = [p.split("version=")[-1] for p in sink.list_dir(spark, base) if "version=" in p]
    return sorted(int(n) for n in names if all(sink.path_exists(spark, f"{base}/version={n}/{t}/_SUCCESS") for t in ("days", "factors")))


def _save(spark: SparkSession, root: str, days: DataFrame, factors: DataFrame) -> None:
    done = _versions(spark, root)
    path = f"{_state_dir(root)}/version={done[-1] + 1 if done else 1}"
    days.write.mode("overwrite").parquet(f"{path}/days")
    factors.write.mode("overwrite").parquet(f"{path}/factors")
    for n in done[:1 - KEEP_VERSIONS]:
        sink.remove(spark, f"{_state_dir(root)}/version={n}")


def _actions(spark: SparkSession, root: str) -> DataFrame:
    raw = src.scan_raw(spark, root, "corp_actions")
    return dedup_first(raw, incremental.KEY, ["ex_date", "ingest_seq"]).select(*incremental.INPUTS)


def _everything(spark: SparkSession, root: str) -> dict:
    """The full run, which later runs start from."""
    days = sink.staged(raw_days(spark, root), "days")
    actions = sink.staged(_actions(spark, root), "actions")
    read = Observation("raw")
    raw = src.scan_daily_layouts(spark, root).observe(read, F.count(F.lit(1)).alias("rows"))
    whole = curate.curate_daily_ohlcv(raw, src.scan_raw(spark, root, "corp_actions")).withColumn("year", F.year("date"))
    sink.write_curated(whole, root, "daily_ohlcv")
    now = src.scan_curated(spark, root, "daily_ohlcv")
    _save(spark, root, days, incremental.factors_from(actions, now))
    seen = now.agg(F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_set("year")).alias("years"), F.count_distinct("symbol").alias("symbols")).first()
    return {"rows_in": read.get["rows"], "rows_out": seen["rows"], "mode": "full", "years": seen["years"], "symbols": seen["symbols"]}


def curate_daily(spark: SparkSession, root: str, date: str | None = None, full: bool = False) -> dict:
    """Curate the daily bars; rows read and written, the years rewritten and the number of symbols whose
    adjustment has changed.

    Without state of an earlier run, or with `full`, everything is curated.  `date` takes up the changes of that
    raw day only and leaves those of other days for a later run; actions are always taken up.
    A raw day that is no longer there loses its bars.
    """
    versions = _versions(spark, root)
    if full or not versions or not sink.path_exists(spark, f"{root}/curated/daily_ohlcv"):
        return _everything(spark, root)
    state = f"{_state_dir(root)}/version={versions[-1]}"
    then, known = spark.read.parquet(f"{state}/days"), spark.read.parquet(f"{state}/factors")
    days = sink.staged(raw_days(spark, root), "days")
    differ = then.select("date", F.col("files").alias("_then")).join(days, "date", "full").where(~F.col("files").eqNullSafe(F.col("_then")))
    if date is not None:
        differ = differ.where(F.col("date") == F.lit(str(date)).cast("date"))
        days = days.join(differ.select("date"), "date", "left_semi").unionByName(then.join(differ.select("date"), "date", "left_anti"))
    dates: list[dt.date] = sorted(r[0] for r in differ.select("date").collect())  # trading days, bounded by the calendar
    out = {"rows_in": 0, "rows_out": 0, "mode": "incremental", "years": [], "symbols": 0}
    old = src.scan_curated(spark, root, "daily_ohlcv")
    touched = F.col("date").isin(dates) if dates else F.lit(False)
    cols = [*curate.DAILY_COLS]
    fresh = changed = None
    if dates:
        raw = src.scan_daily_layouts(spark, root).where(touched)
        out["rows_in"] = raw.count()
        fresh = sink.staged(curate.curate_daily_bars(raw), "bars")
        before = old.where(touched & F.col("year").isin(sorted({d.year for d in dates}))).select(*cols)
        # rows that are new or different, and those that are gone or were different
        changed = sink.staged(fresh.select(*cols).exceptAll(before).unionByName(before.exceptAll(fresh.select(*cols))).select(
            "symbol", "date").distinct(), "changed")
    else:
        fresh = old.select(*cols).limit(0)
        changed = fresh.select("symbol", "date")
    bars = old.where(~touched).select("symbol", "date", "close").unionByName(fresh.select("symbol", "date", "close"))
    factors = sink.staged(incremental.refreshed(_actions(spark, root), known, changed, bars), "factors")
    moved = sink.staged(incremental.moved_symbols(known, factors), "moved")
    earlier = old.join(moved, "symbol").where("date < until").select("year")
    years = sorted(r[0] for r in earlier.unionByName(changed.select(F.year("date").alias("year"))).distinct().collect())
    out |= {"years": years, "symbols": moved.count()}
    if years:
        theirs = factors.join(moved.select("symbol").unionByName(changed.select("symbol")).distinct(), "symbol", "left_semi")
        new = fresh.join(changed, ["symbol", "date"], "left_semi").select(*cols, F.lit(True).alias("_new"))
        rest = old.where(F.col("year").isin(years)).join(changed, ["symbol", "date"], "left_anti").select(*cols, "adj_close", F.lit(False).alias("_new"))
        rows = rest.unionByName(new, allowMissingColumns=True).join(moved, "symbol", "left")
        again = F.col("_new") | F.coalesce(F.col("date") < F.col("until"), F.lit(False))
        rows = incremental.readjusted(rows, theirs, again)
        rows = sink.staged(rows.select(*cols, "adj_close", F.year("date").alias("year")), "curated")
        out["rows_out"] = rows.count()
        sink.write_curated(rows, root, "daily_ohlcv")
    _save(spark, root, days, factors)
    return out
