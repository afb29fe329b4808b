"""Text messages from and to any Spark source and sink.

A message is ``url STRING, ts TIMESTAMP``: the text, and when it was published.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

MESSAGE = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("ts", T.TimestampType())]
)


def normalise(df: DataFrame, text: str = "value", ts: str | None = "timestamp") -> DataFrame:
    """A source's rows as messages. Binary text is UTF-8; a source without a
    time gives NULL."""
    value = F.col(text)
    if isinstance(df.schema[text].dataType, T.BinaryType):
        value = F.decode(value, "UTF-8")
    time = F.lit(None) if ts is None else F.col(ts)
    return df.select(value.cast("string").alias("url"), time.cast("timestamp").alias("ts"))


def read_messages(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: str | T.StructType | None = None,
    text: str = "value",
    ts: str | None = "timestamp",
    streaming: bool = True,
) -> DataFrame:
    """Messages of a Kafka topic (``value``, ``timestamp``), a folder of files or
    any other source, as a stream or all at once."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return normalise(reader.load(), text, ts)


def message_rows(spark: SparkSession, urls: Iterable[str] | Iterable[tuple]) -> DataFrame:
    """Messages from memory: texts, or (text, time) pairs."""
    rows = [(u, None) if u is None or isinstance(u, str) else tuple(u) for u in urls]
    return spark.createDataFrame(rows, MESSAGE)


def write_messages(
    df: DataFrame,
    fmt: str,
    value: Column | str = "value",
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
) -> DataStreamWriter | None:
    """Publish a column as text messages.

    Batch input is written at once. For a stream the writer is returned, to be
    given a trigger and started; it needs a checkpoint folder.
    """
    value = F.col(value) if isinstance(value, str) else value
    out = df.select(value.cast("string").alias("value"))
    options = dict(options or {})
    if not df.isStreaming:
        out.write.format(fmt).options(**options).mode(mode).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return (
        out.writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )
