"""Lake scans (A1) and table bindings (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import curate
from ..sinks import commits
from ..sinks.lake import CURATED_LAYOUT, path_exists

_LANDED = [T.StructField("ingest_seq", T.LongType()), T.StructField("date", T.DateType()),
           T.StructField("batch", T.StringType())]
# what a raw stream holds: the entity, the landing order and the partition columns
RAW_SCHEMAS = {s: T.StructType(list(e.fields) + _LANDED) for s, e in (
    ("ticks", schemas.TICK), ("quotes_l1", schemas.QUOTE_L1), ("quotes_l2", schemas.QUOTE_L2),
    ("index_values", schemas.INDEX_VALUE))}
CURATED_COLS = {
    "ticks": curate.TICK_COLS, "quotes_l1": curate.L1_COLS, "quotes_l2": curate.L2_COLS,
    "index_values": curate.INDEX_COLS, "daily_ohlcv": [*curate.DAILY_COLS, "adj_close"],
    "fundamentals": curate.FUND_COLS, "corp_actions": curate.ACTION_COLS,
    "tickers": curate.TICKER_COLS, "futures_contracts": curate.FUTURE_COLS,
}


def scan_raw(spark: SparkSession, root: str, stream: str, date: str | None = None, version: int | None = None) -> DataFrame:
    """Raw Parquet of one stream or pulled table, one day (partition-pruned) or all days.  The market
    streams are read with their declared schema, pulled tables with that of their newest version (or an earlier one
    that is kept); nothing is inferred."""
    base = f"{root}/raw/{stream}"
    raw = spark.read.schema(RAW_SCHEMAS[stream]).parquet(base) if stream in RAW_SCHEMAS else commits.read(spark, base, version)
    if date is not None:
        raw = raw.where(F.col("date") == F.lit(str(date)).cast("date"))
    if stream == "quotes_l2":
        raw = raw.withColumn("hour", F.hour("ts_event"))
    return raw.drop("batch") if stream in RAW_SCHEMAS else raw


DAILY_LAYOUTS = ("daily_ohlcv", "daily_ohlcv_backfill")


def scan_daily_layouts(spark: SparkSession, root: str) -> DataFrame:
    """Daily bars landed by the nightly job (year/date) and by backfill
    (source/year/date): Spark refuses mixed layouts in one read, so each is
    read by itself and the two are unioned by name (U1)."""
    parts = []
    for sub in DAILY_LAYOUTS:
        p = f"{root}/raw/{sub}"
        if path_exists(spark, p):
            parts.append(commits.read(spark, p))
    if not parts:
        raise FileNotFoundError(f"no daily bars under {root}/raw")
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def scan_curated(spark: SparkSession, root: str, stream: str) -> DataFrame:
    return spark.read.parquet(f"{root}/curated/{stream}")


def curated_columns(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """The curated table in its declared columns and order, without layout columns."""
    return scan_curated(spark, root, stream).select(*CURATED_COLS[stream])


def _column_types() -> dict[str, dict[str, str]]:
    f = {**{x.name: x.dataType.simpleString() for e in (schemas.TICK, schemas.QUOTE_L1, schemas.QUOTE_L2, schemas.INDEX_VALUE)
            for x in e.fields}, "date": "date", "hour": "int", "mid_price": "bigint", "spread_bps": "int"}
    daily = {"date": "date", "symbol": "string", "asset_class": "string", "exchange": "string"}
    daily |= {c: "bigint" for c in CURATED_COLS["daily_ohlcv"] if c not in daily}
    text = {"symbol", "period", "action_type", "name", "exchange", "asset_class", "sector_l1", "sector_l2", "industry",
            "status", "underlying_index"}
    dates = {"as_of_date", "ex_date", "record_date", "payment_date", "listed_date", "expiry_date", "snapshot"}
    whole = {"market_cap", "revenue", "net_income", "total_assets", "total_equity", "lot_size", "tick_size", "contract_size"}

    def kind(c: str) -> str:
        return "string" if c in text else "date" if c in dates else "bigint" if c in whole else "double"
    out = {s: {c: f[c] for c in CURATED_COLS[s]} for s in ("ticks", "quotes_l1", "quotes_l2", "index_values")}
    out["daily_ohlcv"] = daily | {"year": "int"}
    for s in ("fundamentals", "corp_actions", "tickers", "futures_contracts"):
        out[s] = {c: kind(c) for c in CURATED_COLS[s]}
    out["fundamentals"]["quarter"] = "string"
    out["corp_actions"]["year"] = "int"
    return out


def curated_table_ddl(root: str, database: str = "market") -> list[str]:
    """CREATE TABLE statements for a persistent catalog: external Parquet tables
    with their columns and partition columns (A2).  Run `MSCK REPAIR TABLE` after landing."""
    out = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    for t, cols in _column_types().items():
        listed = ", ".join(f"`{c}` {k}" for c, k in cols.items())
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({listed}) USING parquet "
                   f"PARTITIONED BY ({', '.join(CURATED_LAYOUT[t])}) LOCATION '{root}/curated/{t}'")
    return out


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Temp views over every curated table present under `root` (A2, session scope)."""
    made = []
    for t in CURATED_LAYOUT:
        if path_exists(spark, f"{root}/curated/{t}"):
            scan_curated(spark, root, t).createOrReplaceTempView(t)
            made.append(t)
    return made


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """User SQL with named parameters bound by Spark (A13): `:name` markers."""
    return spark.sql(query, args=params)
