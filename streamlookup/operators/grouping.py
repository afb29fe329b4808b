"""Grouping values by key, and co-grouping two collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.functions.messages import quoted, reject_duplicates
from streamlookup.operators.skew import with_chunk


def _collect(
    df: DataFrame, keys: Sequence[str], lists: Sequence[Column], chunks: int, deal: Column | None
) -> DataFrame:
    """Lists per key and chunk."""
    reject_duplicates([*df.columns, "chunk"])
    groups = [quoted(k) for k in keys]
    if chunks > 1:
        df, groups = with_chunk(df, chunks, deal), [*groups, F.col("chunk")]
    if not df.isStreaming:
        # Lists get no smaller by being begun before the shuffle, only slower to
        # move: the rows are shuffled as they are, once.
        df = df.repartition(*groups)
    found = df.groupBy(*groups).agg(*lists)
    if chunks > 1:
        return found
    # A constant among the keys would cost a second shuffle.
    names = [c for c in found.columns if c not in keys]
    return found.select(*[quoted(k) for k in keys], F.lit(0).alias("chunk"), *[quoted(c) for c in names])


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str] | None = None,
    into: str = "values",
    chunks: int = 1,
    deal: Column | None = None,
) -> DataFrame:
    """All values of each key as a list of structs.

    Returns the keys, ``chunk`` and the list: a row per key and chunk that has values,
    whatever the sizes. One chunk is a list per key, which has to fit in a task;
    where a key may be hot give as many ``chunks`` as its rows need, and ``deal`` to say
    which row goes to which (an integer, counted modulo ``chunks``). On a stream
    one of the keys must be a window over a watermarked column.
    """
    values = list(values or [c for c in df.columns if c not in keys])
    rows = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *values])])
    items = F.collect_list(F.struct(*[quoted(v) for v in values])).alias(into)
    return _collect(rows, keys, [items], chunks, deal)


def tagged_union(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_name: str = "left", right_name: str = "right"
) -> DataFrame:
    """Both collections in one: the keys, and a struct per side that is NULL on
    the other side's rows."""

    def tagged(df: DataFrame, name: str) -> DataFrame:
        values = [quoted(c) for c in df.columns if c not in keys] or [F.lit(True).alias("present")]
        return df.select(*[quoted(k) for k in keys], F.struct(*values).alias(name))

    return tagged(left, left_name).unionByName(tagged(right, right_name), allowMissingColumns=True)


def cogroup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_name: str = "left",
    right_name: str = "right",
    chunks: int = 1,
    deal: Column | None = None,
) -> DataFrame:
    """Per key the list of left values and the list of right values.

    Keys found on one side only are kept, with an empty list for the other.
    ``chunks`` and ``deal`` are as in :func:`group_values`; ``deal`` sees the keys and the
    two structs. Each side is shuffled once. On streams both sides need a
    watermark and a window among the keys.
    """
    both = tagged_union(left, right, keys, left_name, right_name)
    items = [F.collect_list(quoted(name)).alias(name) for name in (left_name, right_name)]
    return _collect(both, keys, items, chunks, deal)


def cogroup_aggregate(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    left_name: str = "left",
    right_name: str = "right",
) -> DataFrame:
    """Co-group without lists: aggregates over ``left.*`` and ``right.*``.

    Rows are combined before the shuffle, so a hot key costs no more than any
    other. Prefer it wherever the lists are only reduced afterwards.
    """
    both = tagged_union(left, right, keys, left_name, right_name)
    return both.groupBy(*[quoted(k) for k in keys]).agg(*aggregates)
