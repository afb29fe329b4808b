"""The latest event per key on a stream without windows, kept up to date outside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from streamlookup.functions.messages import quoted
from streamlookup.operators.latest import latest_per_key
from streamlookup.sources.versions import read_table, replace_table, versions
from streamlookup.streaming.batches import to_folder

_BATCH = "batch_id"


def running_latest(
    events: DataFrame, keys: Sequence[str], sink: str, checkpoint: str, ts: str = "ts", tie_break: Sequence[str] = ()
) -> DataStreamWriter:
    """Keep the latest event of each key, over all that the stream has brought.

    State holds a row per key, for good. Every micro-batch writes the rows of the keys whose latest
    event changed to a folder of its own below ``sink``; one that is repeated after a failure
    replaces its folder, so an update counts once. Late events need no watermark: an older one changes nothing.
    Read the result with :func:`read_latest`, and now and then call :func:`compact_latest`.
    """
    latest = latest_per_key(events, keys, ts, tie_break)
    write = to_folder(f"{sink}/changes")
    return latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def _changes(spark: SparkSession, sink: str, schema: T.StructType, after: int) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/changes")
    columns = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(f"{sink}/changes").where(F.col(_BATCH) > after)


def _base(spark: SparkSession, sink: str) -> tuple[DataFrame | None, int]:
    """The compacted rows, and the last micro-batch that is in them."""
    if not versions(spark, f"{sink}/base"):
        return None, -1
    base = read_table(spark, f"{sink}/base")
    return base, base.agg(F.max(_BATCH)).first()[0]


def _merged(spark: SparkSession, sink: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    base, last = _base(spark, sink)
    rows = _changes(spark, sink, schema, last)
    return latest_per_key(rows if base is None else base.unionByName(rows), keys, _BATCH)


def read_latest(spark: SparkSession, sink: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The latest row of every key as of the last finished micro-batch; ``schema`` is that of the events."""
    return _merged(spark, sink, schema, keys).select(*[quoted(f.name) for f in schema.fields])


def compact_latest(spark: SparkSession, sink: str, schema: T.StructType, keys: Sequence[str]) -> int | None:
    """Put the finished micro-batches together into a row per key, and delete their folders.

    Returns the last micro-batch that is in, None if there is nothing new. The stream may go on
    meanwhile; readers see the same rows before and after. A micro-batch that is repeated later writes
    a folder that is not read again.
    """
    _, last = _base(spark, sink)
    newest = _changes(spark, sink, schema, last).agg(F.max(_BATCH)).first()[0]
    if newest is None:
        return None
    rows = _merged(spark, sink, schema, keys).where(F.col(_BATCH) <= newest)
    # The last batch's number has to be in, whichever rows are the latest.
    replace_table(rows.withColumn(_BATCH, F.lit(newest)), f"{sink}/base")
    store_path = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/changes")
    store = store_path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(store_path):
        number = status.getPath().getName().removeprefix(f"{_BATCH}=")
        if number.isdigit() and int(number) <= newest:
            store.delete(status.getPath(), True)
    return newest
