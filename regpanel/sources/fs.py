"""Existence and listing of paths through Hadoop's file system API, so that
local paths, ``file:``, ``hdfs://`` and object-store URIs behave alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """The file system of a path, and the path in its own terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists. False means *not found* and nothing
    else: an unknown scheme, missing rights or a dead store raise."""
    fs, at = _open(spark, path)
    return bool(fs.exists(at))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty where it does not exist."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return []
    return [s.getPath().getName() for s in fs.listStatus(at)]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``; one that is there stays."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        fs.create(at, False).close()


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file, or a folder with all it holds; false where there is none."""
    fs, at = _open(spark, path)
    return bool(fs.delete(at, True))


def is_local(path: str) -> bool:
    """Whether a path names this machine's own file system."""
    scheme = path.split("://", 1)[0] if "://" in path else path.split(":", 1)[0] if path.startswith("file:") else ""
    return scheme in ("", "file")
