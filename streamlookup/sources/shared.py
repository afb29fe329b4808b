"""Folders that every executor can reach, and tables kept there for a while."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

# Folders of the tables written in the innermost `temporary` block.
_folders: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, among those of this application.

    A session that names no such folder gets one in its warehouse, which is shared as tables are; if that
    is a folder of this machine, only a session whose executors run here may use it. The name has its
    file system in it, so that Spark and whoever else opens it mean the same.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
        if qualified(spark, base).startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach: the warehouse is on this machine")
    base = qualified(spark, base)
    return f"{base.rstrip('/')}/streamlookup/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme that Spark takes it for."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = name.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(name).toString()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, for tasks that read or write its files themselves, and its path there.

    Takes a URI of a file system that pyarrow knows (file, hdfs, s3 or s3a, gs, abfs), or a path of this machine.
    """
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, worked out once and read back from a work folder.

    What made it is not run again, neither by several uses nor when an executor
    is lost, and Spark knows its size. It stays, as it may be used as long as the
    session runs, unless written inside a :func:`temporary` block.
    """
    folder = work_folder(df.sparkSession, name)
    if (folders := _folders.get()) is not None:
        folders.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside the block when it ends. Whatever uses
    them has to be stored by then."""
    token = _folders.set([])
    try:
        yield
    finally:
        folders = _folders.get()
        _folders.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
