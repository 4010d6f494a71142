"""Symbol universe from a list file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_universe(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines holding JSON strings ("vnm") or objects ({"symbol": "VNM"}) ->
    distinct upper-case symbols, sorted.  Blank and unparsable lines are skipped."""
    raw = F.trim(F.col(col))
    v = F.try_parse_json(raw)
    sym = F.coalesce(F.try_variant_get(v, "$.symbol", "string"),
                     F.when(raw.startswith('"'), F.try_variant_get(v, "$", "string")))
    return (lines.select(F.upper(F.trim(sym)).alias("symbol"))
            .where(F.col("symbol").isNotNull() & (F.col("symbol") != ""))
            .distinct().orderBy("symbol"))


def distinct_symbols(bars: DataFrame) -> DataFrame:
    """SELECT DISTINCT symbol ... ORDER BY symbol."""
    return bars.select("symbol").distinct().orderBy("symbol")
