"""Vendor pulls -> canonical tables (P5-P9), source fallback (J11), date gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

# (column, type, aliases) in output order
FUNDAMENTALS_SPEC = [("as_of_date", "date", ["report_date", "date", "reportDate"]), ("symbol", "string", []),
                     ("period", "string", [])] + [
    (c, "double", []) for c in ("pe", "pb", "eps", "bvps", "roe", "roa", "debt_to_equity")] + [
    (c, "bigint", []) for c in ("market_cap", "revenue", "net_income", "total_assets", "total_equity")]
CORP_ACTIONS_SPEC = [("ex_date", "date", ["ngay_giao_dich_khong_huong_quyen", "ex_dividend_date", "ex", "exDate"]),
                     ("record_date", "date", []), ("payment_date", "date", []), ("symbol", "string", []),
                     ("action_type", "string", []), ("ratio", "double", []), ("amount", "double", [])]
TICKERS_SPEC = [("symbol", "string", []), ("name", "string", []), ("exchange", "string", []),
                ("asset_class", "string", []), ("sector_l1", "string", []), ("sector_l2", "string", []),
                ("industry", "string", []), ("status", "string", []), ("listed_date", "date", []),
                ("lot_size", "bigint", []), ("tick_size", "bigint", []), ("foreign_room_pct", "double", [])]
FUTURES_SPEC = [("symbol", "string", []), ("underlying_index", "string", []), ("expiry_date", "date", []),
                ("contract_size", "bigint", []), ("tick_size", "bigint", []), ("margin_pct", "double", [])]


def conform(df: DataFrame, spec, lenient_dates: bool = True) -> DataFrame:
    """Select `spec` columns: take the column or its first present alias, cast
    to the target type (dates leniently: unparsable text -> null), and add the
    missing ones as typed nulls.  Extra columns are dropped."""
    cols = []
    present = set(df.columns)
    for name, typ, aliases in spec:
        src = next((c for c in [name, *aliases] if c in present), None)
        if src is None:
            cols.append(F.lit(None).cast(typ).alias(name))
        elif typ == "date" and lenient_dates and dict(df.dtypes)[src] == "string":
            cols.append(F.try_to_date(F.col(src), "yyyy-MM-dd").alias(name))
        else:
            cols.append(F.col(src).cast(typ).alias(name))
    return df.select(*cols)


def normalize_daily(vendor: DataFrame, asset_class: str = "equity", exchange: str = "HOSE") -> DataFrame:
    """Vendor bars (thousands, float) -> canonical daily rows (P5): prices x10
    truncated to long, value = close * volume, foreign flows as typed nulls."""
    scaled = {c: (F.col(c) * 10).cast("long") for c in ("open", "high", "low", "close")}
    vol = F.col("volume").cast("long")
    return vendor.select(
        F.to_date("time").alias("date"), "symbol", F.lit(asset_class).alias("asset_class"),
        F.lit(exchange).alias("exchange"), *[v.alias(k) for k, v in scaled.items()],
        vol.alias("volume"), (scaled["close"] * vol).alias("value"),
        F.lit(None).cast("long").alias("foreign_buy_vol"), F.lit(None).cast("long").alias("foreign_sell_vol"))


def normalize_fundamentals(vendor: DataFrame) -> DataFrame:
    """period = '<year>-Q<quarter>' when year/quarter are given; aliases and fills."""
    df = vendor
    if "year" in df.columns and "quarter" in df.columns:
        df = df.withColumn("period", F.concat(F.col("year").cast("string"), F.lit("-Q"),
                                              F.col("quarter").cast("string"))).drop("year", "quarter")
    return conform(df, FUNDAMENTALS_SPEC)


def normalize_corp_actions(vendor: DataFrame) -> DataFrame:
    return conform(vendor, CORP_ACTIONS_SPEC)


def normalize_tickers(vendor: DataFrame) -> DataFrame:
    return conform(vendor, TICKERS_SPEC)


def normalize_futures(vendor: DataFrame) -> DataFrame:
    return conform(vendor, FUTURES_SPEC)


def source_priority(results: DataFrame) -> DataFrame:
    """Per symbol the first source (lowest rank) that did not fail; symbols where
    every source failed get source null and status 'all_sources_failed' (J11).
    An empty-but-successful pull counts as success, as in the reference."""
    ok = F.when(F.col("status") == "ok", F.col("rank"))
    best = results.groupBy("symbol").agg(F.min(ok).alias("_r"))
    names = results.select("symbol", F.col("rank").alias("_r"), "source")
    return (best.join(names, ["symbol", "_r"], "left")
            .select("symbol", "source",
                    F.when(F.col("_r").isNull(), F.lit("all_sources_failed")).otherwise(F.lit("ok")).alias("status")))


def forward_actions(actions: DataFrame, run_date, days: int = schemas.FORWARD_ACTION_DAYS) -> DataFrame:
    """Actions with ex_date in [run_date, run_date + days]."""
    d = F.lit(str(run_date)).cast("date")
    return actions.where(F.col("ex_date").between(d, F.date_add(d, days)))


def is_quarterly_report_date(date_col) -> object:
    """Within +-3 days of a filing deadline, comparing days of the same month only."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    cond = None
    for m, d in schemas.QUARTERLY_REPORT_DATES.values():
        x = (F.month(c) == m) & (F.abs(F.dayofmonth(c) - d) <= schemas.QUARTERLY_WINDOW_DAYS)
        cond = x if cond is None else (cond | x)
    return cond


def plan_chunks(days: DataFrame, n: int, col: str = "date") -> DataFrame:
    """Split the days between min(col) and max(col) into n contiguous chunks,
    the first (count % n) one day longer; n is capped at the number of days;
    no days -> no chunks (W6).

    The range bounds are two scalars; the chunk of a day is arithmetic on its
    offset, so there is no global sort: a groupBy gives the chunk bounds.
    """
    if n < 1:
        raise ValueError(f"cannot split days into {n} chunks")
    lo, hi = days.agg(F.min(col), F.max(col)).first()
    spark = days.sparkSession
    if lo is None:
        return spark.createDataFrame([], "chunk int, start date, end date")
    total = (hi - lo).days + 1
    k = min(n, total)
    size, extra = divmod(total, k)
    big = extra * (size + 1)
    seq = spark.range(total).select(F.col("id").alias("_i"))
    chunk = F.when(F.col("_i") < big, F.floor(F.col("_i") / (size + 1))).otherwise(
        extra + F.floor((F.col("_i") - big) / size))
    day = F.date_add(F.lit(str(lo)).cast("date"), F.col("_i").cast("int"))
    return (seq.select((chunk + 1).cast("int").alias("chunk"), day.alias("_d")).groupBy("chunk")
            .agg(F.min("_d").alias("start"), F.max("_d").alias("end")))


def gate_by_chunk(df: DataFrame, chunks: DataFrame, col: str) -> DataFrame:
    """Rows whose `col` lies inside a chunk, tagged with the chunk.
    Chunks are a handful of rows (one per backfill task): broadcast."""
    return df.join(F.broadcast(chunks), F.col(col).between(F.col("start"), F.col("end"))).drop("start", "end")


