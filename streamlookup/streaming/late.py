"""Late rows kept: told from those in time, instead of dropped."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from streamlookup.functions.messages import quoted, reject_duplicates
from streamlookup.operators.skew import with_chunk
from streamlookup.streaming.batches import to_folder

# Groups in which rows pass the operator; as many tasks can work on a micro-batch.
PARTS = 64

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
# Numbers that a double does not hold; they travel as text.
_EXACT = (T.LongType, T.DecimalType)


def mark_late(events: DataFrame, ts: str, size: str, into: str = "late", parts: int = PARTS) -> DataFrame:
    """Every row of a stream, with a flag: whether the watermark had passed the end of its window before it came.

    Windowed operators drop such rows; here they stay and can be sent elsewhere, see :func:`split_late`.
    The watermark is the one that Spark works out from ``ts`` for the micro-batch a row comes in. The
    operator keeps no state: it has to be a stateful one to see the watermark. Rows pass in ``parts`` groups
    whatever their values, so no key makes a task large. A row without a time is in no window, and late. On
    batch input nothing else is late. Columns of nested types are not taken: make them text first.
    """
    reject_duplicates([*events.columns, into])
    if nested := [f.name for f in events.schema.fields if isinstance(f.dataType, _NESTED)]:
        raise ValueError(f"columns of nested types: {nested}")
    if not events.isStreaming:
        return events.withColumn(into, F.col(ts).isNull())
    values = [quoted(f.name).cast("string") if isinstance(f.dataType, _EXACT) else quoted(f.name) for f in events.schema.fields]
    # Windows are counted from the epoch.
    length = F.expr(f"unix_millis(timestamp_micros(0) + INTERVAL {size})")
    millis = F.unix_millis(quoted(ts))
    end = F.coalesce(millis - F.pmod(millis, length) + length, F.lit(-1).cast("long"))
    named = [c.alias(f"c{i}") for i, c in enumerate(values)]
    rows = with_chunk(events, parts).select(*named, "chunk", end.alias("__end"))
    kinds = ["string" if isinstance(f.dataType, _EXACT) else f.dataType.simpleString() for f in events.schema.fields]
    out = ", ".join([*(f"c{i} {kind}" for i, kind in enumerate(kinds)), "late boolean"])
    names = [f"c{i}" for i in range(len(kinds))]

    def mark(key: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        for frame in frames:
            yield frame[names].assign(late=frame["__end"] <= passed)

    marked = rows.groupBy("chunk").applyInPandasWithState(mark, out, "none int", "append", GroupStateTimeout.NoTimeout)
    back = [F.col(n).cast(f.dataType).alias(f.name) for n, f in zip(names, events.schema.fields)]
    return marked.select(*back, F.col("late").alias(into))


def split_late(marked: DataFrame, on_time: str, late: str, checkpoint: str, flag: str = "late") -> DataStreamWriter:
    """Write the rows of :func:`mark_late` to two folders, those in time and the late ones, without the flag.

    Each micro-batch has a folder of its own in both; a repeated one replaces them, so every row is in one
    of them once.
    """
    in_time, others = to_folder(on_time), to_folder(late)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            in_time(batch.where(~F.col(flag)).drop(flag), batch_id)
            others(batch.where(F.col(flag)).drop(flag), batch_id)
        finally:
            batch.unpersist()

    return marked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
