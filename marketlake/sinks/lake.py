"""Writers for the lake: raw landing, curated overwrite, side tables.

Layout (relative to a lake root):
    raw/<stream>/date=D/.../batch=B/       market streams: a batch replaces itself only
    raw/<table>/commit=C/<partition dirs>/ daily bars, fundamentals, actions, reference: merged by key (commits.py)
    curated/<stream>/<partition dirs>/     partitions present in the result are replaced (idempotent re-runs)
    _ops/rejected/<stream>/date=D/batch=B/ quarantine
    _ops/parse-errors/channel=C/date=D/batch=B/
    _ops/ingest-receipts/date=D/stream=S/batch=B/   JSON lines
    _ops/permanent-gaps/S.jsonl/run=R/     JSON lines
    _ops/dead-letters/topic=T/run=R/       text lines

Every overwrite names the dynamic mode itself, so it never depends on a session setting, and
nothing outside the partitions of the data at hand is touched.  A micro-batch or job run that is repeated
writes the same batch directories again: nothing is doubled.

Skew: rows are rebalanced by their partition columns, so AQE splits a large partition over several
tasks and joins small ones, by measured size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..session import checkpoint_dir
from . import commits
from .fs import list_dir, move, path_exists, remove

__all__ = ["list_dir", "move", "path_exists", "remove"]

RAW_LAYOUT = {
    "ticks": ["date", "asset_class", "batch"],
    "quotes_l1": ["date", "asset_class", "batch"],
    "quotes_l2": ["date", "asset_class", "batch"],
    "index_values": ["date", "batch"],
}
CURATED_LAYOUT = {
    "ticks": ["date", "asset_class"],
    "quotes_l1": ["date", "asset_class"],
    "quotes_l2": ["date", "asset_class"],
    "index_values": ["date"],
    "daily_ohlcv": ["year"],
    "fundamentals": ["quarter"],
    "corp_actions": ["year"],
    "tickers": ["snapshot"],
    "futures_contracts": ["snapshot"],
}
# keys by which a landing replaces rows of earlier landings
LANDING_KEYS = {
    "daily_ohlcv": ["symbol", "date"],
    "daily_ohlcv_backfill": ["symbol", "date"],
    "fundamentals": ["symbol", "period", "as_of_date"],
    "corp_actions": ["symbol", "ex_date", "action_type"],
    "tickers": ["symbol", "snapshot"],
    "futures_contracts": ["symbol", "snapshot"],
}
LANDING_LAYOUT = {
    "daily_ohlcv": ["year", "date"],
    "daily_ohlcv_backfill": ["source", "year", "date"],
    "fundamentals": ["quarter"],
    "corp_actions": ["year"],
    "tickers": ["snapshot"],
    "futures_contracts": ["snapshot"],
}
MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], mode: str = "append",
                      max_records: int = MAX_RECORDS_PER_FILE, fmt: str = "parquet",
                      sort_cols: Sequence[str] = ()) -> None:
    """Files partitioned by `partition_cols`; mode='overwrite' replaces only the
    partitions present in `df`.  `sort_cols` orders rows inside files, for min/max pruning."""
    out = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    w = out.write.mode(mode).option("maxRecordsPerFile", max_records).partitionBy(*partition_cols).format(fmt)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    w.save(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written aside in the shared folder and read back: computed once, its source free to change."""
    spark = df.sparkSession
    aside = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    return spark.read.schema(df.schema).parquet(aside)


def _with_batch(df: DataFrame, batch: str) -> DataFrame:
    return df.withColumn("batch", F.lit(str(batch)))


def land_stream(df: DataFrame, root: str, stream: str, batch: str) -> None:
    """Accepted rows of a stream under its raw layout; `batch` names the micro-batch or job run."""
    write_partitioned(_with_batch(df, batch), f"{root}/raw/{stream}", RAW_LAYOUT[stream], "overwrite")


def write_curated(df: DataFrame, root: str, stream: str) -> None:
    """Idempotent replace of the curated partitions present in `df`."""
    sort = [c for c in ("symbol", "index_code") if c in df.columns]
    write_partitioned(df, f"{root}/curated/{stream}", CURATED_LAYOUT[stream], "overwrite", sort_cols=sort)


def quarantine(rejected: DataFrame, root: str, stream: str, batch: str) -> None:
    """Rejected rows with their reasons."""
    out = rejected if "date" in rejected.columns else rejected.withColumn("date", F.to_date("ts_event"))
    write_partitioned(_with_batch(out, batch), f"{root}/_ops/rejected/{stream}", ["date", "batch"], "overwrite")


def quarantine_parse_errors(errors: DataFrame, root: str, batch: str) -> None:
    """Unparsable messages: channel, raw, ts, error."""
    out = _with_batch(errors.withColumn("date", F.to_date("ts")), batch)
    write_partitioned(out, f"{root}/_ops/parse-errors", ["channel", "date", "batch"], "overwrite")


def write_receipts(receipts: DataFrame, root: str, batch: str) -> None:
    """Receipts as JSON lines by date and stream (S3); both stay in the lines too, so that each line
    can be read by itself."""
    out = receipts.withColumns({"day": F.col("date"), "of": F.col("stream"), "batch": F.lit(str(batch))})
    write_partitioned(out, f"{root}/_ops/ingest-receipts", ["day", "of", "batch"], "overwrite", fmt="json")


def record_gaps(gaps: DataFrame, root: str, stream: str, run: str = "0") -> None:
    """Gap records (stream, start, end, reason, recorded_at) of one job run as JSON lines (S6); the same run again
    replaces its own records."""
    out = gaps.select("stream", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"),
                      "reason", F.col("recorded_at").cast("string").alias("recorded_at"), F.lit(run).alias("run"))
    write_partitioned(out, f"{root}/_ops/permanent-gaps/{stream}.jsonl", ["run"], "overwrite", fmt="json")


def export_dead_letters(lines: DataFrame, root: str, run: str = "0") -> DataFrame:
    """Dead-letter lines (topic, value) as text files by topic and job run; the same run again replaces its own files.
    Returns messages per topic (S7)."""
    write_partitioned(lines.withColumn("run", F.lit(run)), f"{root}/_ops/dead-letters", ["topic", "run"], "overwrite", fmt="text")
    return lines.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def land_table(df: DataFrame, root: str, table: str, keep: int = 0) -> int:
    """Pulled rows of a table: they replace earlier rows of their keys, others stay (S9-S12).  Returns the version committed;
    rows that do not fit the table's schema are refused, see `commits`."""
    return commits.merge(df, f"{root}/raw/{table}", LANDING_LAYOUT[table], LANDING_KEYS[table], schemas.PULLED[table], keep)


def land_daily(bars: DataFrame, root: str, keep: int = 0) -> int:
    """Daily bars by (year, date) (S9).  Symbol is not a directory level: ~1,600
    tiny files a day would be the result."""
    return land_table(bars.withColumn("year", F.year("date")), root, "daily_ohlcv", keep)


def land_backfill(bars: DataFrame, root: str, source: str = "backfill", keep: int = 0) -> int:
    """Daily bars of a backfill by (source, year, date)."""
    rows = bars.withColumns({"source": F.lit(source), "year": F.year("date")})
    return land_table(rows, root, "daily_ohlcv_backfill", keep)


def land_fundamentals(df: DataFrame, root: str, keep: int = 0) -> int:
    return land_table(df if "quarter" in df.columns else df.withColumn("quarter", F.col("period")), root, "fundamentals", keep)


def land_corp_actions(df: DataFrame, root: str, keep: int = 0) -> int:
    return land_table(df.withColumn("year", F.year("ex_date")), root, "corp_actions", keep)


def land_reference(df: DataFrame, root: str, table: str, keep: int = 0) -> int:
    return land_table(df, root, table, keep)
