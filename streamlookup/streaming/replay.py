"""Bounded runs of a stream: process what is there, close the windows, stop."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamlookup.functions.eventtime import with_event_time

def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of them, as a stream.

    The source takes folders and patterns only, so the path is made a pattern
    that nothing else matches.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def time_ranges(df: DataFrame, by: str, parts: int) -> list[DataFrame]:
    """A table in ``parts`` ranges of a time, ascending, of about as many rows each. Rows without a time come first."""
    bounds = df.agg(F.percentile_approx(by, [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    kind = df.schema[by].dataType
    edges = [F.lit(b).cast(kind) for b in sorted(set(bounds or []))]
    above = [None, *edges]
    below = [*edges, None]
    return [
        df.where(
            (F.lit(True) if low is None else F.col(by) > low)
            & (F.lit(True) if high is None else F.col(by) <= high)
            | (F.col(by).isNull() if low is None else F.lit(False))
        )
        for low, high in zip(above, below)
    ]


def files_in_turn(parts: Iterable[DataFrame], folder: str, files: int = 1) -> str:
    """Write tables one after the other, as ``files`` files each, into one folder, and return it.

    A stream that reads ``files`` of them at a time sees one table per micro-batch, in this order: the file source
    goes by the time at which a file was written, and a table is begun when the one before is
    there. Where times are kept in whole seconds, a second passes in between. Empty tables are left out.
    """
    for part in parts:
        if part.isEmpty():
            continue
        part.repartition(files).write.mode("append").parquet(folder)
        spark = part.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        time.sleep(0.01 if any(f.getModificationTime() % 1000 for f in found) else 1.1)
    return folder


def run_available(
    df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", allow_late: bool = True
) -> StreamingQuery:
    """Append all available input to a folder and stop. The checkpoint and the
    folder's log give each row exactly once, also after a restart. Unless
    ``allow_late``, rows dropped for being later than the watermark are an error."""
    query = (
        df.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    kept = int(df.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if not allow_late and (late := late_rows(query, kept)):
        raise RuntimeError(f"{late} rows (or groups of rows) came after the watermark and were dropped")
    return query


def late_rows(query: StreamingQuery, kept: int) -> int:
    """How many rows stateful operators have dropped for being late; rows that are
    combined before the shuffle count once for a task and group. ``kept`` is of how
    many micro-batches the session keeps the progress."""
    progress = query.recentProgress
    if len(progress) >= kept:
        raise RuntimeError(f"progress is kept of {kept} micro-batches only: raise numRecentProgressUpdates")
    return sum(state["numRowsDroppedByWatermark"] for p in progress for state in p["stateOperators"])


def replay(spark: SparkSession, df: DataFrame, work: str) -> DataFrame:
    """Run a stream over all available input; its output as a batch table."""
    run_available(df, f"{work}/out", f"{work}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{work}/out")


def replay_windows(
    spark: SparkSession,
    events: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    work: str,
    delay: str,
    longest: timedelta,
    ts: str = "ts",
    closing: Mapping[str, object] | None = None,
    allow_late: bool = False,
) -> DataFrame:
    """As :func:`replay` for a query with windows of up to ``longest``, which all get closed.

    For tests and replays only. Spark keeps a window open until a later event moves
    the watermark on. So the query first runs over the events, then goes on from
    its checkpoint with one event later than the greatest time seen by twice the
    longest window and the delay, whose own window never closes. That event has the
    ``closing`` values and NULL elsewhere. ``build`` gets the events with a
    watermark of ``delay`` on ``ts``.

    Fails if events were dropped as too late, unless ``allow_late``, and if windows are
    still open in the end: the output is whole, or there is none.
    """
    schema = events.schema
    folder = f"{work}/closing"
    spark.createDataFrame([], schema).write.parquet(folder)
    both = events.unionByName(spark.readStream.schema(schema).parquet(folder))
    # Always true, but never moved, as it differs between tasks. It keeps the
    # filters of `build` above the watermark, which must see the closing event.
    marked = with_event_time(both, ts, delay).where(F.spark_partition_id() >= 0)
    query = build(marked)
    first = run_available(query, f"{work}/out", f"{work}/checkpoint", allow_late=allow_late)

    seen = [p["eventTime"]["max"] for p in first.recentProgress if "max" in (p["eventTime"] or {})]
    if seen:
        late = spark.sql(f"SELECT INTERVAL {delay} AS late").first()["late"]
        last = datetime.fromisoformat(max(seen).replace("Z", "+00:00"))
        # A window of any offset that holds the last event ends before this.
        values = {**(closing or {}), ts: last + late + 2 * longest}
        columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
        spark.range(1).select(*columns).write.mode("append").parquet(folder)
        second = run_available(query, f"{work}/out", f"{work}/checkpoint", allow_late=allow_late)
        open_rows = [state["numRowsTotal"] for state in second.recentProgress[-1]["stateOperators"]]
        if any(n > 1 for n in open_rows):
            raise RuntimeError(f"windows longer than {longest} are still open: {open_rows} rows of state")
    return spark.read.schema(query.schema).parquet(f"{work}/out")
