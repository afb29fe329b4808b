"""When results of a stream come out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.functions.messages import quoted

# Lists in which a window's events of one partition and micro-batch wait, dealt at random: copies are dealt
# like all others, and no task gets all events of a window.
LISTS = 16


def hold_until_close(events: DataFrame, ts: str, size: str, window: str = "window") -> DataFrame:
    """Hold events back until the watermark passes the end of their window.

    Each event comes out once, with its ``window``; copies are kept. Events later than the
    watermark, and events without a time, are dropped. Needs a watermark on ``ts``; batch input
    just gets the window.

    What a partition of a micro-batch has of a window is written to the state once, as ``LISTS``
    lists at most, and read once, when the window closes. A list is bounded by what the source gives to a
    partition. Rows are dealt in the order of their partition, which a repeated task has to see again, as
    it does behind a source.
    """
    if not events.isStreaming:
        return events.withColumn(window, F.window(ts, size))
    # The watermark survives on the window only; the event's own time travels
    # as an ordinary value.
    values = [(F.unix_micros(ts) if c == ts else quoted(c)).alias(f"c{i}") for i, c in enumerate(events.columns)]
    dealt = [F.current_timestamp().alias("__batch"), F.spark_partition_id().alias("__part"), F.floor(F.rand(0) * LISTS).alias("__list")]
    kept = (
        events.select(F.col(ts), F.struct(*values).alias("__event"), *dealt)
        .groupBy(F.window(ts, size).alias(window), "__batch", "__part", "__list")
        .agg(F.collect_list("__event").alias("__events"))
    )
    found = [F.col("__event")[f"c{i}"] for i in range(len(events.columns))]
    columns = [(F.timestamp_micros(v) if c == ts else v).alias(c) for c, v in zip(events.columns, found)]
    return kept.select(window, F.explode("__events").alias("__event")).select(*columns, window)
