"""Dealing the rows of groups into chunks, for groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlookup.functions.messages import quoted


def _comparable(df: DataFrame) -> list[Column]:
    """The columns in a form that can be hashed."""
    return [
        F.to_json(F.struct(quoted(f.name))) if isinstance(f.dataType, (T.MapType, T.VariantType)) else quoted(f.name)
        for f in df.schema.fields
    ]


def with_chunk(df: DataFrame, chunks: int, deal: Column | None = None) -> DataFrame:
    """Add ``chunk`` in [0, chunks), a part of the group that a row belongs to.

    ``deal`` is an integer that is counted modulo ``chunks``. Without it the number is
    made of the task's partition and the row's values, so that copies are spread
    too and a repeated task computes the same.
    """
    if chunks < 1:
        raise ValueError(f"chunks must be 1 or more, got {chunks}")
    if deal is None:
        deal = F.xxhash64(F.spark_partition_id(), *_comparable(df))
    return df.withColumn("chunk", F.pmod(deal, F.lit(chunks)).cast("int"))
