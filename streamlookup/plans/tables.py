"""The driver's tables, and the lookup tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import with_event_time
from streamlookup.functions.urls import url_host
from streamlookup.sources.shared import work_folder
from streamlookup.streaming.replay import files_in_turn, stream_table, time_ranges

# Bytes of a stored table that a micro-batch of a replay reads, and that a file has, about;
# there are a few micro-batches whatever the size.
BATCH_BYTES = 32 << 30
FILE_BYTES = 128 << 20
LEAST_BATCHES = 4

# Folders of the copies in time order, and how many files of each belong together.
_copies: dict[tuple[str, str], tuple[str, int]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant."""
    return with_event_time(table(spark, sf_dir, "events"))


def stored_bytes(df: DataFrame) -> int:
    """The size of a stored table, as the optimizer knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def files_of(size: int, batches: int) -> int:
    """How many files each of so many micro-batches needs."""
    return max(1, -(-size // (batches * FILE_BYTES)))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as they are stored, for queries that need no order."""
    schema = table(spark, sf_dir, "events").schema
    return with_event_time(stream_table(spark, f"{sf_dir}/events.parquet", schema))


def ordered_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the order of their time, in several micro-batches, from a copy that a session
    makes once."""
    rows = table(spark, sf_dir, "events")
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _copies:
        size = stored_bytes(rows)
        batches = max(LEAST_BATCHES, -(-size // BATCH_BYTES))
        files = files_of(size, batches)
        folder = files_in_turn(time_ranges(rows, "ts", batches), work_folder(spark, "events"), files)
        _copies[name] = folder, files
    folder, files = _copies[name]
    return with_event_time(stream_table(spark, folder, rows.schema, files))


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "pages").schema
    return stream_table(spark, f"{sf_dir}/pages.parquet", schema).select("page_id", "url")


def affiliates(spark: SparkSession, sf_dir: str, least_pages: int = 1) -> DataFrame:
    """A table keyed by host: hosts with at least ``least_pages`` pages, so that a
    higher number leaves URLs without a match."""
    return (
        page_messages(spark, sf_dir)
        .groupBy(url_host("url").alias("source_domain"))
        .agg(F.min("page_id").alias("id"), F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= least_pages)
        .select("id", "source_domain", F.round(F.col("pages") / F.lit(100.0), 2).alias("compensation"))
    )
