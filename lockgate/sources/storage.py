"""Paths on the cluster's file system, and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

#: Codec of layers and of what is staged for them; digests take half the space of the default's.
CODEC = "zstd"


@cache
def local_folder() -> str:
    """A folder of this machine, removed when the process ends."""
    root = tempfile.mkdtemp(prefix="lockgate-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session may do without one; anywhere else a machine-local folder would not
    be visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = local_folder()
    return f"{root.rstrip('/')}/lockgate/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` once and reads it back; returns the frame and its path.

    Used where a result behind a shuffle is read several times. Unlike a cache
    it survives lost executors, and later reads prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path), path


def _hadoop(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _hadoop(spark, path)
    return fs.exists(handle)


def delete(spark: SparkSession, path: str) -> None:
    fs, handle = _hadoop(spark, path)
    fs.delete(handle, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or directory, whose new place must be free."""
    fs, handle = _hadoop(spark, source)
    _, place = _hadoop(spark, target)
    fs.mkdirs(place.getParent())
    if not fs.rename(handle, place):
        raise OSError(f"cannot move {source} to {target}")


def children(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """(name, path, is a directory) of everything directly under ``path``."""
    fs, handle = _hadoop(spark, path)
    if not fs.exists(handle):
        return []
    listed = []
    for status in fs.listStatus(handle):
        child = status.getPath()
        listed.append((child.getName(), child.toString(), status.isDirectory()))
    return listed


def partitions(spark: SparkSession, path: str, column: str) -> list[tuple[str, str]]:
    """(value, directory) of the partition directories of ``column`` under ``path``."""
    prefix = f"{column}="
    return [
        (unquote(name.removeprefix(prefix)), child)
        for name, child, is_dir in children(spark, path)
        if is_dir and name.startswith(prefix)
    ]
