"""How large a table is, before it is sent to every executor."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlookup.functions.messages import quoted

# Largest table, in bytes as measured below, that a lookup broadcasts.
BROADCAST_LIMIT = 64 * 1024 * 1024

# Bytes counted per row besides its variable-length values: row header and the
# hash table's pointer, and one word per column.
_ROW_BYTES = 32
_WORD = 8


def _variable_bytes(field: T.StructField):
    value = quoted(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(value)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.octet_length(F.to_json(F.struct(value)))
    return None


def fits(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether a table's uncompressed size is within the limit.

    Without a job if the optimizer's estimate, which for stored tables is their
    compressed size, is beyond the limit already. Else one aggregate counts the rows
    and adds up their values; a row of two numbers reaches the driver.
    """
    statistics = df._jdf.queryExecution().optimizedPlan().stats()
    if _stored(df) and int(str(statistics.sizeInBytes())) > limit:
        return False
    sizes = [size for size in map(_variable_bytes, df.schema.fields) if size is not None]
    row = reduce(add, [F.coalesce(size.cast("bigint"), F.lit(0)) for size in sizes], F.lit(0).cast("bigint"))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()
    return found["rows"] * (_ROW_BYTES + _WORD * len(df.columns)) + found["bytes"] <= limit


def _stored(df: DataFrame) -> bool:
    """Whether the plan reads whole columns of a stored table. Only then is the
    optimizer's estimate a size that was found and not one that was assumed."""
    nodes = [line.lstrip(" :+-") for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    whole = re.compile(r"Project |Relation |Filter isnotnull\([^()]*\)$")
    return all(whole.match(node) for node in nodes if node)
