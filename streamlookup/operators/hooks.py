"""Where callers plug in their own functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_elements(df: DataFrame, element: Column | str, fn: Callable[[Column], Column], into: str) -> DataFrame:
    """One output per element. ``fn`` maps a column to a column: a built-in
    expression, or a pandas UDF where Python is unavoidable."""
    element = F.col(element) if isinstance(element, str) else element
    return df.withColumn(into, fn(element))


def flat_map_elements(df: DataFrame, element: Column | str, fn: Callable[[Column], Column], into: str) -> DataFrame:
    """Any number of outputs per element: one row for every item of the array
    ``fn`` returns, none for an empty array."""
    element = F.col(element) if isinstance(element, str) else element
    return df.withColumn(into, F.explode(fn(element)))


def flat_map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame | Iterable[pd.DataFrame]],
    schema: str | T.StructType,
) -> DataFrame:
    """Any number of outputs for a batch of rows, in Python. Works on streams;
    memory is bounded by the Arrow batch size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            result = fn(batch)
            for out in [result] if isinstance(result, pd.DataFrame) else result:
                # The columns of an empty frame seldom have the declared types.
                if len(out):
                    yield out

    return df.mapInPandas(run, schema)
