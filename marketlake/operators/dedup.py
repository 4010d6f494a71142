"""Keep-first deduplication (W7) and the curators built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per `keys`: the first by `order`.

    `order` must be a total order inside a key (end it with a unique ingest
    column), otherwise the kept row is not reproducible.  Planned as a
    shuffle on the keys plus a WindowGroupLimit (the partial limit runs before
    the shuffle, so heavy duplication is cut map-side).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))
