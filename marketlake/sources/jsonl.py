"""JSON-lines side files: gaps (A7), dead letters (A8), receipts (A9), equity curves.

Readers take a frame of text lines (`spark.read.text(path)` gives one) so the
same parsing serves files, tables and streams.  Bad lines are skipped, never
fatal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file under `path`; a missing path reads as no lines."""
    try:
        return spark.read.text(path)
    except Exception as e:  # noqa: BLE001 - absent file = empty, as in the reference
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], "value string")
        raise


def _object(line):
    return F.trim(line).startswith("{") & F.get_json_object(line, "$").isNotNull()


def lenient_date(c):
    return F.try_to_date(c, "yyyy-MM-dd")


def read_gaps(lines: DataFrame, col: str = "value") -> DataFrame:
    """stream, start, end (dates; null when not an ISO date), reason, recorded_at."""
    g = lines.where(_object(F.col(col))).select(F.from_json(F.col(col), schemas.GAP).alias("g"))
    return g.select("g.stream", lenient_date(F.col("g.start")).alias("start"),
                    lenient_date(F.col("g.end")).alias("end"), "g.reason", "g.recorded_at")


def read_dead_letters(lines: DataFrame, col: str = "value") -> DataFrame:
    """data, attributes (map), publish_time from dead-letter export lines."""
    d = lines.where(_object(F.col(col))).select(F.from_json(F.col(col), schemas.DEAD_LETTER).alias("d"))
    return d.select("d.data", "d.attributes", "d.publish_time")


RECEIPT = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("min_ts", T.TimestampType()), T.StructField("max_ts", T.TimestampType()),
    T.StructField("schema_version", T.StringType()), T.StructField("stream", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("symbol", T.StringType()),
])


def read_receipts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Receipt JSON lines -> typed rows."""
    r = lines.where(_object(F.col(col))).select(F.from_json(F.col(col), RECEIPT).alias("r"))
    return r.select("r.*")


def receipts_to_lines(receipts: DataFrame) -> DataFrame:
    return receipts.select(F.to_json(F.struct(*receipts.columns)).alias("value"))


def read_equity_curve(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Equity curve file (CSV with header, or Parquet): requires date and equity."""
    df = (spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path))
    return check_equity_curve(df)


def check_equity_curve(df: DataFrame) -> DataFrame:
    for needed in ("date", "equity"):
        if needed not in df.columns:
            raise ValueError(f"an equity curve needs a column {needed}; got {', '.join(df.columns)}")
    cols = [F.to_date("date").alias("date"), F.col("equity").cast("double").alias("equity")]
    if "position" in df.columns:
        cols.append(F.col("position").cast("double").alias("position"))
    else:
        cols.append(F.lit(None).cast("double").alias("position"))
    keys = [c for c in ("strategy",) if c in df.columns]
    return df.select(*keys, *cols)
