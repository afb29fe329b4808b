"""Correlation ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_uuid(df: DataFrame, into: str = "__key") -> DataFrame:
    """Add a random id per row.

    The ids are for output only. They change when a task is run again, so no
    operator here joins or groups on them.
    """
    return df.withColumn(into, F.expr("uuid()"))
