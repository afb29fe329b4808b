"""Enrichment per micro-batch, as an ordinary batch job."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from streamlookup.sources.messages import write_messages
from streamlookup.sources.shared import temporary

BatchWriter = Callable[[DataFrame, int], None]


def enrich_batches(
    events: DataFrame,
    enrich: Callable[[DataFrame], DataFrame],
    write: BatchWriter,
    checkpoint: str,
) -> DataStreamWriter:
    """Hand ``enrich(batch)`` of every micro-batch to ``write``.

    ``enrich`` sees a bounded table, so everything a batch job can do is open to
    it: look up distinct keys only, measure the lookup table again, or read it
    anew to get its current rows. Tables it writes on the way are deleted after
    the micro-batch.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        # Read more than once by lookups that first collect the distinct keys.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with temporary(batch.sparkSession):
                write(enrich(batch), batch_id)
        finally:
            batch.unpersist()

    return events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def to_folder(sink: str, fmt: str = "parquet") -> BatchWriter:
    """Write each micro-batch to a folder of its own. A repeated one replaces its
    folder, so every result is there once."""

    def write(result: DataFrame, batch_id: int) -> None:
        result.write.format(fmt).mode("overwrite").save(f"{sink}/batch_id={batch_id}")

    return write


def to_messages(fmt: str, options: Mapping[str, str]) -> BatchWriter:
    """Publish the ``value`` column of each micro-batch, at least once."""

    def write(result: DataFrame, batch_id: int) -> None:
        write_messages(result, fmt, options=options)

    return write
