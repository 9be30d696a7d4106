"""Folders on the file system a path belongs to (HDFS, object storage, local): staged replacement."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _on(spark, path)
    return fs.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _on(spark, path)
    fs.delete(folder, True)


def _beside(path: str, what: str) -> str:
    """A hidden sibling of ``path``: readers of the parent folder do not list it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}-{uuid.uuid4().hex[:12]}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a folder beside ``path`` and put it in the place of ``path``.

    If ``write`` fails, what stood at ``path`` is untouched and the part result is removed. The
    swap is two renames (on stores without a rename it is as good as theirs); if the second
    fails, the first is undone.
    """
    path = path.rstrip("/")
    staged, old = _beside(path, "staged"), _beside(path, "old")
    try:
        write(staged)
    except BaseException:
        remove(spark, staged)
        raise
    fs, target = _on(spark, path)
    _, new = _on(spark, staged)
    _, kept = _on(spark, old)
    before = fs.exists(target)
    if before and not fs.rename(target, kept):
        remove(spark, staged)
        raise OSError(f"cannot replace {path}")
    if not fs.rename(new, target):
        if before:
            fs.rename(kept, target)
        remove(spark, staged)
        raise OSError(f"cannot put the new result at {path}")
    if before:
        fs.delete(kept, True)
