"""Lookup tables: read from a database, files or the catalog, and loaded."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC table. With a partition column and its bounds the table
    is read by ``partitions`` tasks, which is also the number of connections."""
    split = {
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": partitions,
    }
    if partition_column is not None and any(v is None for v in split.values()):
        raise ValueError("a partitioned read needs a column, both bounds and the number of partitions")
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": fetch_size, **split}
    return {**{k: str(v) for k, v in options.items() if v is not None}, **(properties or {})}


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A database table; see :func:`jdbc_options`. Constant filters and column
    selections are evaluated by the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def write_jdbc(
    dim: DataFrame,
    column_types: str | None = None,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    truncate: bool = False,
    **options,
) -> None:
    """Drop, create and fill a database table by batched inserts, over at most
    ``partitions`` connections. ``truncate`` keeps the table definition."""
    writer = dim.write.format("jdbc").mode(mode).options(**jdbc_options(**options))
    writer = writer.option("batchsize", batch_size).option("truncate", str(truncate).lower())
    if column_types is not None:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.save()


def read_dim(spark: SparkSession, fmt: str, location: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A lookup table kept as files (a path) or in the catalog (``table``, a name)."""
    if fmt == "table":
        return spark.read.options(**(options or {})).table(location)
    return spark.read.format(fmt).options(**(options or {})).load(location)


def write_dim(
    dim: DataFrame,
    fmt: str,
    location: str,
    mode: str = "overwrite",
    buckets: int | None = None,
    bucket_key: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace a lookup table kept as files or in the catalog.

    A catalog table may be bucketed by its lookup key. A merge join with events
    bucketed alike then shuffles neither side.
    """
    writer = dim.write.mode(mode).options(**(options or {}))
    if buckets is not None:
        if fmt != "table" or bucket_key is None:
            raise ValueError("buckets need a catalog table and a key")
        writer = writer.bucketBy(buckets, bucket_key).sortBy(bucket_key)
    if fmt == "table":
        writer.saveAsTable(location)
    else:
        writer.format(fmt).save(location)


def dim_rows(spark: SparkSession, rows: Iterable, schema: str | T.StructType) -> DataFrame:
    """A small lookup table from memory."""
    return spark.createDataFrame(list(rows), schema)
