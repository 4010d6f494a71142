"""Size-aware compaction of landed streams.

Micro-batches leave a small file per flush and partition.  A compaction lists files with their sizes, takes the partitions whose
closed batches hold files well below the target, rewrites each as files of about the target and swaps them in under one
batch name.  The newest batches stay as they are, as a stream may still replay them.

The swap is a journal of (staged folder, its place, folders it replaces), written before anything is moved.  A run that
dies is finished by the next one from the journal, each step of which may be repeated; until then a reader may see rows
twice, which curation settles by key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lake

TARGET_BYTES = 128 << 20
#: Newest batches that are left alone.
KEEP_BATCHES = 2


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, batch, length) of the Parquet files of a landed stream, from their listing alone; `folder` is the partition's, above the batch."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.regexp_extract("path", "^(.*)/batch=[^/]*/", 1).alias("folder"),
                        F.regexp_extract("path", "/batch=([^/]*)/", 1).alias("batch"), "length")


def plan_compaction(files: DataFrame, target: int = TARGET_BYTES, keep: int = KEEP_BATCHES) -> DataFrame:
    """(folder, batches, last, bytes, files, into): the partitions to rewrite and the number of files for each.

    Closed are batches of earlier compactions and numbered ones but the `keep` newest of the whole stream.  A partition is
    rewritten if it holds more files than about the target needs.
    """
    number = F.col("batch").try_cast("long")
    newest = files.select(number.alias("n")).where("n is not null").distinct().orderBy(F.desc("n")).limit(keep)
    closed = files.withColumn("n", number).join(newest.select(F.col("n").alias("_open")), F.col("n") == F.col("_open"), "left_anti")
    per = closed.groupBy("folder").agg(F.collect_set("batch").alias("batches"), F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"),
                                       F.max(F.coalesce("n", F.regexp_extract("batch", "-([0-9]+)$", 1).try_cast("long"))).alias("last"))
    into = F.greatest(F.lit(1), F.round(F.col("bytes") / target)).cast("int")
    return per.withColumn("into", into).where((F.col("files") > 2 * F.col("into")) | ((F.col("files") > F.col("into")) & (F.size("batches") > 1)
                                                                                       & (F.col("bytes") < F.col("files") * target / 2)))


def _journal(root: str, stream: str) -> str:
    return f"{root}/_ops/compaction/{stream}/journal"


def _apply(spark: SparkSession, root: str, stream: str) -> int:
    """Finish the swaps of the journal, if there is one; their number."""
    path = _journal(root, stream)
    if not lake.path_exists(spark, f"{path}/_SUCCESS"):
        return 0
    swaps = spark.read.schema("staged string, place string, old array<string>").json(path).collect()  # one row per partition rewritten
    for s in swaps:
        if lake.path_exists(spark, s["staged"]):
            lake.remove(spark, s["place"])
            lake.move(spark, s["staged"], s["place"])
        for old in s["old"]:
            if old != s["place"]:
                lake.remove(spark, old)
    lake.remove(spark, path)
    return len(swaps)


def compact_stream(spark: SparkSession, root: str, stream: str, target: int = TARGET_BYTES, keep: int = KEEP_BATCHES) -> dict:
    """Compact the landed partitions of a stream; partitions rewritten, files before and after."""
    _apply(spark, root, stream)
    path = f"{root}/raw/{stream}"
    out = {"stream": stream, "partitions": 0, "files_before": 0, "files_after": 0}
    if not lake.path_exists(spark, path):
        return out
    swaps = []
    for p in plan_compaction(listed_files(spark, path), target, keep).collect():  # the partitions flushed since the last run
        name = f"compacted-{p['last']}"
        old = [f"{p['folder']}/batch={b}" for b in sorted(p["batches"])]
        staged = f"{root}/_ops/compaction/{stream}/{uuid.uuid4().hex}"
        rows = spark.read.parquet(*old)
        order = [c for c in ("symbol", "index_code", "ts_event") if c in rows.columns]
        # ranges of symbol and time are even, whatever one symbol holds, and let readers skip files
        rows.repartitionByRange(p["into"], *order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(staged)
        swaps.append((staged, f"{p['folder']}/batch={name}", old))
        out["files_before"] += p["files"]
        out["files_after"] += p["into"]
    if swaps:
        spark.createDataFrame(swaps, "staged string, place string, old array<string>").coalesce(1).write.mode("overwrite").json(_journal(root, stream))
        out["partitions"] = _apply(spark, root, stream)
    return out
