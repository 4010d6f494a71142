"""Session settings shared by jobs, tests and the bench.

Runtime settings are applied to whatever session the caller hands us
(`configure`), so the same code runs under a cluster-provided session and
under the local test session built by `local_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  All are runtime-settable SQL confs.
RUNTIME_CONF = {
    # one wall-clock convention: instants are UTC, local time is derived explicitly
    "spark.sql.session.timeZone": "UTC",
    # curated writes replace only the partitions present in the batch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # runtime re-planning: coalesce small shuffles, split skewed partitions,
    # turn sort-merge joins into broadcast joins when a side is measured small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # what a task sorts should not spill, and rows take some ten times their shuffled bytes in a sort and more of a file's:
    # shuffle partitions are joined up to this size only, and files are read in small splits
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "8MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; a cluster that installs it needs nothing."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's `spark.checkpoint.dir`.

    Only a local session that has none (tests, bench) gets a scratch folder; on a
    cluster the executors could not read one, so the setting is required there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "marketlake") -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARKETLAKE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark
