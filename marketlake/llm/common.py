"""Helpers shared by the operators: shared-folder tables, size-checked joins, words."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: The same characters, for str.strip; bytes.split() without arguments splits on exactly these.
BLANKS = " \t\n\v\f\r"


#: Bounds of an Arrow batch: rows, and bytes where Spark knows that setting.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 500, "spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, or one of this process in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="marketlake-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` written once as Parquet in the shared folder: a scan of it, and its place."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and return a scan of it: the
    lineage ends there, so a lost executor re-reads files and recomputes nothing upstream."""
    return written_at(df, name)[0]


def forget(spark: SparkSession, path: str) -> None:
    """Remove a table of `written_at` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_side(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """`df` with a broadcast hint if its counted `rows` are at most `most`, else
    unchanged, so that Spark shuffles both sides (AQE splits hot keys)."""
    return F.broadcast(df) if rows <= most else df


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, as spark.executorEnv.PYTHONPATH
    would (a cluster that installs it needs nothing), and bound what a worker holds at once: whole texts
    travel in Arrow batches, so batches are bounded by bytes and by few rows."""
    for name, most in ARROW_BATCH.items():
        now = spark.conf.get(name, None)
        if now is None or not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (long); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


#: Stands in for a null id where ids are compared: after all others.
LAST_ID = 2**63 - 1


def ordered_id(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(LAST_ID))


def given_id(c: Column) -> Column:
    return F.when(c != LAST_ID, c)


def row_key(id_col: str, text_col: str) -> Column:
    """A row is known by its id and its text, so rows that share an id, or have none, are told apart."""
    i, t = F.col(id_col), F.col(text_col)
    return F.xxhash64(i.cast("string"), i.isNull(), t, t.isNull())  # nulls leave a hash as it is
