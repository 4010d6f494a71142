"""Landings of pulled tables as commits (S9-S12): several writers at once, readers that see whole landings only, and schemas with
versions (A1).

    <table>/commit=<id>/<partition dirs>/     rows written by one landing, never changed
    <table>/_log/commits/<version>.json       what a version has changed: the commit that holds each of its partitions now

A landing reads the newest version, writes its merged partitions into a folder of its own and then creates the next file of
the log, which only one writer can.  A writer that comes second looks at what has been committed in between: if that
is in other partitions it takes the next number, else it merges again over the newer rows.  Nothing is moved, and what a
landing that dies has written is in no version.

Each version carries the table's schema.  It starts from the declared one; a landing may add columns, which older
rows have as null, and leave columns out.  A column of another type is refused with its name, unless it fits without
loss.  Readers use the schema of their version, so that no file is opened to infer one.

Partitions that a later version has replaced are removed when `keep` more versions are there.  With 0, the default, a plain scan of the
folder is right between landings, but a reader that started before a landing may have to start again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fs

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
MAX_RECORDS_PER_FILE = 5_000_000
#: Types that may land in a column of a wider type.
FITS = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
        ("float", "double"), ("tinyint", "double"), ("smallint", "double"), ("int", "double")}


class LandingConflict(RuntimeError):
    """Other writers kept changing the same partitions."""


class SchemaRefused(ValueError):
    """Rows that do not fit the table's schema."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    folders: dict[str, str]  # partition folder -> the commit that holds it


def _log_dir(path: str) -> str:
    return f"{path}/_log/commits"


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("version long, place string, commit string, schema string").json(_log_dir(path))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest version of a table, or an earlier one that is still kept; None if nothing has been committed."""
    if not fs.path_exists(spark, _log_dir(path)):
        return None
    while True:
        log = _log(spark, path)
        if version is not None:
            log = log.where(F.col("version") <= version)
        rows = log.groupBy("place").agg(F.max_by("commit", "version").alias("commit"), F.max_by("schema", "version").alias("schema"),
                                        F.max("version").alias("version"), F.count(F.lit(1)).alias("n")).collect()  # one row per partition folder
        head = [r for r in rows if r["place"] is None]
        if not head:
            return None
        if head[0]["n"] == head[0]["version"]:
            break  # each version has one head; else the listing missed a file
    return Snapshot(head[0]["version"], T.StructType.fromJson(json.loads(head[0]["schema"])),
                    {r["place"]: r["commit"] for r in rows if r["place"] is not None})


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders that hold the rows of the newest version; the table's own folder if it has no log."""
    snap = snapshot(spark, path)
    return [path] if snap is None else [f"{path}/commit={c}/{p}" for p, c in sorted(snap.folders.items())]


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of one version of a table; a folder without a log is read as it is."""
    snap = snapshot(spark, path, version)
    return spark.read.parquet(path) if snap is None else _rows(spark, path, snap)


def _rows(spark: SparkSession, path: str, snap: Snapshot, touched: set[tuple] | None = None) -> DataFrame:
    folders = [f"{path}/commit={c}/{p}" for p, c in sorted(snap.folders.items()) if touched is None or _values(p) in touched]
    if not folders:
        return spark.createDataFrame([], snap.schema)
    return spark.read.schema(snap.schema).option("basePath", path).parquet(*folders).select(*snap.schema.names)


def _values(place: str) -> tuple:
    """The partition values of a folder."""
    raw = [unquote(x.split("=", 1)[1]) for x in place.split("/")]
    return tuple(None if x == NO_VALUE else x for x in raw)


def evolved(known: T.StructType | None, landing: T.StructType, required: Sequence[str] = ()) -> T.StructType:
    """The schema after a landing: `known` and the columns that the landing adds.  Names are compared as Spark does, without case."""
    names = [f.name.lower() for f in landing]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SchemaRefused(f"column {twice[0]} stands twice in the landing")
    missing = [c for c in required if c.lower() not in names]
    if missing:
        raise SchemaRefused(f"column {missing[0]} is missing, it is part of the table's key or layout")
    have = {f.name.lower(): f for f in known or []}
    added = []
    for f in landing:
        if f.name.lower() not in have:
            if isinstance(f.dataType, T.NullType):
                raise SchemaRefused(f"column {f.name} is new and has no type")
            added.append(T.StructField(f.name, f.dataType))
            continue
        want, got = have[f.name.lower()].dataType.simpleString(), f.dataType.simpleString()
        if got != want and got != "void" and (got, want) not in FITS:
            raise SchemaRefused(f"column {f.name} is {got}, the table has {want}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in known or []] + added)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` in the columns and types of a schema; columns it lacks are null."""
    have = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def schema_versions(spark: SparkSession, path: str) -> list[tuple[int, T.StructType]]:
    """The versions of a table that have changed its schema."""
    heads = _log(spark, path).where("place is null").orderBy("version").collect()  # one row per landing
    out: list[tuple[int, T.StructType]] = []
    for h in heads:
        s = T.StructType.fromJson(json.loads(h["schema"]))
        if not out or out[-1][1] != s:
            out.append((h["version"], s))
    return out


def _without(old: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `old` whose keys are not in `df`; nulls are equal to nulls."""
    new = df.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return old.join(new, cond, "left_anti")


def _write(df: DataFrame, folder: str, partition_cols: Sequence[str]) -> None:
    df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option(
        "compression", "zstd").partitionBy(*partition_cols).parquet(folder)


def merge(df: DataFrame, path: str, partition_cols: Sequence[str], keys: Sequence[str], declared: T.StructType | None = None,
          keep: int = 0, attempts: int = 20) -> int:
    """Land rows so that they replace the rows of equal `keys` in the same partitions and keep all others; the version committed
    (the present one if there are no rows).  Only partitions that `df` has rows in are read and written.
    A folder from before the log is taken into the first version whole.
    """
    spark = df.sparkSession
    touched = None
    for _ in range(attempts):
        snap = snapshot(spark, path)
        before = None
        if snap is None:
            snap = Snapshot(0, declared or T.StructType([]), {})
            if fs.path_exists(spark, path) and fs.folders_with_files(spark, path, ".parquet"):
                before = _from_before(spark, path)
        schema = evolved(snap.schema, before.schema) if before is not None else snap.schema
        schema = evolved(schema, df.schema, [*partition_cols, *keys])
        new = conformed(df, schema)
        if touched is None:
            # the partitions of one landing, as the log lists them
            touched = {tuple(None if v is None or v == "" else str(v) for v in r) for r in new.select(*partition_cols).distinct().collect()}
        if not touched:
            return snap.version
        old = before if before is not None else _rows(spark, path, snap, touched)
        commit = f"c{uuid.uuid4().hex}"
        _write(_without(conformed(old, schema), new, keys).unionByName(new), f"{path}/commit={commit}", partition_cols)
        places = fs.folders_with_files(spark, f"{path}/commit={commit}", ".parquet")
        while True:
            version = snap.version + 1
            lines = [{"version": version, "schema": json.dumps(schema.jsonValue())}]
            lines += [{"version": version, "place": p, "commit": commit} for p in places]
            if fs.create_once(spark, f"{_log_dir(path)}/{version:010d}.json", "\n".join(map(json.dumps, lines)) + "\n"):
                if before is not None:
                    _remove_from_before(spark, path)
                if version > keep:
                    expire(spark, path, keep, only=version - keep)
                return version
            now = snapshot(spark, path)
            if now.schema != snap.schema or any(now.folders.get(p) != snap.folders.get(p) for p in places) or before is not None:
                break
            snap = now
        fs.remove(spark, f"{path}/commit={commit}")
    raise LandingConflict(f"{path}: {attempts} landings met commits of other writers in the same partitions")


def _from_before(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that stand under a table's folder without a commit; None if there are none."""
    folders = [f"{path}/{n}" for n, _ in fs.entries(spark, path) if "=" in n and not n.startswith("commit=")]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None


def _remove_from_before(spark: SparkSession, path: str) -> None:
    for name, _ in fs.entries(spark, path):
        if "=" in name and not name.startswith("commit="):
            fs.remove(spark, f"{path}/{name}")


def expire(spark: SparkSession, path: str, keep: int = 0, only: int | None = None, orphans_after_s: float | None = None) -> int:
    """Remove the partition folders that were replaced `keep` versions ago or earlier (`only`: by this version), and with
    `orphans_after_s` also commits in no version, left by landings that died longer ago than that.  The number removed."""
    log = _log(spark, path).where("place is not null").select(
        "place", "commit", F.lead("version").over(Window.partitionBy("place").orderBy("version")).alias("until"))
    if only is None:
        newest = snapshot(spark, path).version
        gone = log.where(F.col("until") <= newest - keep)
    else:
        gone = log.where(F.col("until") == only)
    removed = 0
    for r in gone.collect():  # partition folders of the landings concerned
        folder = f"{path}/commit={r['commit']}/{r['place']}"
        if fs.path_exists(spark, folder):
            fs.remove(spark, folder)
            removed += 1
    if orphans_after_s is not None:
        known = {r[0] for r in _log(spark, path).where("commit is not null").select("commit").distinct().collect()}  # one per landing
        for name, changed in fs.entries(spark, path):
            if name.startswith("commit=") and name[len("commit="):] not in known and changed / 1000 < time.time() - orphans_after_s:
                fs.remove(spark, f"{path}/{name}")
                removed += 1
    return removed
