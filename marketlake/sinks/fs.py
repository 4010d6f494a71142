"""File system calls on the driver: listings, removals and files that are created once."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Paths of the entries of a folder."""
    p, fs = _at(spark, path)
    return [str(x.getPath()) for x in fs.listStatus(p)]


def entries(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of the last change in ms) of the entries of a folder."""
    p, fs = _at(spark, path)
    return [(x.getPath().getName(), x.getModificationTime()) for x in fs.listStatus(p)]


def folders_with_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Folders below `path`, relative to it, that hold a file with this ending."""
    p, fs = _at(spark, path)
    base = str(fs.makeQualified(p)).rstrip("/") + "/"
    found, files = set(), fs.listFiles(p, True)
    while files.hasNext():
        f = files.next().getPath()
        if f.getName().endswith(suffix):
            found.add(str(f.getParent())[len(base):])
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _at(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """A file with this text, whole or not at all; False if there is one already.  Of several writers one succeeds."""
    p, fs = _at(spark, path)
    if fs.getScheme() == "file":
        return _linked(p.toUri().getPath(), text)
    return renamed_once(spark, path, text)


def _linked(path: str, text: str) -> bool:
    """A hard link fails if its name is taken, on local and on network file systems."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    aside = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with open(aside, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(aside, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.remove(aside)


def renamed_once(spark: SparkSession, path: str, text: str) -> bool:
    """A rename that does not overwrite, which distributed file systems do in one step."""
    p, fs = _at(spark, path)
    jvm = spark._jvm
    fs.mkdirs(p.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never = spark.sparkContext._gateway.new_array(rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, never)
        return True
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
