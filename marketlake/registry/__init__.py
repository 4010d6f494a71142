"""Named queries over the test tables, each paired with an independent SQL oracle.

`QUERIES[name](spark, sf_dir) -> DataFrame` and `ORACLE[name]` (DuckDB SQL over
the same parquet tables).  Entries without an oracle are checked by tests.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..bindings import TestLake
from ..bindings_sql import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = ["curated", "market", "research", "calendar", "raw", "ops", "analytics"]
_lakes: dict[tuple[str, str, float], TestLake] = {}


def lake(spark: SparkSession, sf_dir: str) -> TestLake:
    key = (spark.sparkContext.applicationId, sf_dir, spark.sparkContext.startTime)
    if key not in _lakes:
        _lakes[key] = TestLake(spark, sf_dir)
    return _lakes[key]


def finish(df: DataFrame) -> DataFrame:
    """Output boundary: instants leave as zone-less timestamps (like the inputs),
    so results do not depend on the reader's time zone."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register `fn(lake) -> DataFrame` under `name` with its oracle SQL."""
    def deco(fn: Callable[[TestLake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(lake(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise
