"""Python over slices of a table's Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from streamlookup.llm.caches import give_back

# Rows handed to Python at once; long texts make a row weigh megabytes.
SLICE_ROWS = 256


def map_slices(
    df: DataFrame, function: Callable[..., dict], schema: str | StructType, rows: int = SLICE_ROWS
) -> DataFrame:
    """Apply ``function`` to slices of ``df``.

    It gets a list per column, and returns a sequence per column of ``schema``.
    There is no shuffle, and no more than a slice's results are held.
    """
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = function(*[column.to_pylist() for column in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def map_groups(
    df: DataFrame, keys: Sequence[str], function: Callable[[dict[str, tuple]], Iterable[tuple]], schema: str
) -> DataFrame:
    """Apply ``function`` to each group of rows with the same ``keys`` (two or more).

    It gets the group's columns and returns rows of ``schema``. A task reads its rows in
    the order of the keys and holds one group at a time: for very many small groups
    that is far cheaper than a frame for each.
    """
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names = [*keys, *(c for c in df.columns if c not in keys)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        groups = (zip(*group) for _, group in groupby(rows, key=itemgetter(*range(len(keys)))))
        found = (row for group in groups for row in function(dict(zip(names, group))))
        while part := list(islice(found, SLICE_ROWS * 16)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

    return df.select(*names).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
