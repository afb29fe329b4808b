"""Lookup tables that are replaced while others read them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_LOG = "_versions"
_NUMBER = re.compile(r"\d{12}")


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the complete versions of a table, ascending."""
    store, log = _store(spark, folder), _path(spark, folder, _LOG)
    if not store.exists(log):
        return []
    names = [status.getPath().getName() for status in store.listStatus(log)]
    return sorted(int(name) for name in names if _NUMBER.fullmatch(name))


def replace_table(df: DataFrame, folder: str) -> int:
    """Write the next version of a table, and return its number.

    Rows are written to a folder of their own; only when they are complete is the
    version entered, by creating a small file whose name no other writer can take. Readers see the
    table as it was until then, and as it is from then on. A failed write leaves nothing that is read.
    """
    spark = df.sparkSession
    data = f"rows-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    df.write.parquet(f"{folder}/{data}")
    store = _store(spark, folder)
    while True:
        number = (versions(spark, folder) or [-1])[-1] + 1
        # The entry is written aside and renamed: its name is there only with its content.
        aside = _path(spark, folder, _LOG, f".{data}")
        out = store.create(aside, True)
        out.write(data.encode())
        out.close()
        if store.rename(aside, _path(spark, folder, _LOG, f"{number:012d}")):
            return number
        if number not in versions(spark, folder):
            raise OSError(f"cannot enter a version below {folder}")


def read_table(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of a table, the newest unless told otherwise.

    The version is chosen now and stays: whatever is done with the result, also later
    and in several jobs, reads those rows, though the table be replaced meanwhile. On a stream hand the
    call to ``enrich_batches`` or ``publish`` as a function, to choose anew in each micro-batch.
    """
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise ValueError(f"{folder} has no version{'' if version is None else f' {version}'}")
    entry = _path(spark, folder, _LOG, f"{known[-1] if version is None else version:012d}")
    stream = _store(spark, folder).open(entry)
    data = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return spark.read.parquet(f"{folder}/{data}")


def remove_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions, and return their numbers. Call it when no reader of an older one
    is left."""
    if keep < 1:
        raise ValueError("the newest version has to stay")
    store, old = _store(spark, folder), versions(spark, folder)[:-keep]
    for number in old:
        rows = read_table(spark, folder, number).inputFiles()
        store.delete(_path(spark, folder, _LOG, f"{number:012d}"), False)
        for parent in {file.rsplit("/", 1)[0] for file in rows}:
            store.delete(_path(spark, parent), True)
    return old
