"""Lookup joins: match every event with rows of a lookup table.

Match policies
    ``inner``        an output per match, none for a miss
    ``left``         an output per match, one with a NULL match for a miss
    ``exactly_one``  one output per event; the job fails on a miss or on several matches
    ``collect``      every event, with the list of its matches, in as many chunks as asked for

Strategies
    ``auto``   batch: measure the table, then broadcast it or use ``merge``.
               Stream: left to Spark, which decides anew in every micro-batch.
    ``merge``  sort-merge join; adaptive execution splits hot keys
    ``keys``   batch: read only the rows that the events' distinct keys refer to,
               then as ``auto``; for tables far larger than what one input uses
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlookup.functions.messages import quoted, reject_duplicates
from streamlookup.operators.batching import group_values_bounded
from streamlookup.operators.bloom import bloom_filter, prune
from streamlookup.operators.grouping import group_values
from streamlookup.operators.sizing import BROADCAST_LIMIT, fits
from streamlookup.sources.shared import written

MATCHES = ("inner", "left", "exactly_one", "collect")
STRATEGIES = ("auto", "merge", "keys")

# Distinct keys that are sent to the table's source as an IN list. With more
# keys the table is reduced by a semi-join.
IN_LIST_LIMIT = 1_000

_KEY = "__lookup_key"
_DIM_KEY = "__dim_key"
_COUNT = "__dim_count"
_LIST = "__dim_list"
_DEAL = "__deal"


def lookup_join(
    events: DataFrame,
    dim: DataFrame,
    key: Column | str,
    dim_key: Column | str,
    matches: str = "inner",
    strategy: str = "auto",
    into: str = "match",
    project: Sequence[Column] | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    chunks: int = 1,
    deal: Column | None = None,
    list_size: int | None = None,
) -> DataFrame:
    """Join events with the rows of ``dim`` whose ``dim_key`` equals ``key``.

    The match is a struct column ``into`` next to the event's columns, so names
    may occur on both sides. For ``collect`` it is an array of structs, empty
    for a miss; the event appears once per ``chunk`` (a column) of its key's rows, of
    which there are ``chunks`` at most, dealt by ``deal`` as in
    :func:`~streamlookup.operators.grouping.group_values`: give more than one where a
    key's rows are too many for a list. With ``list_size`` no list is longer than that, and a key has as many
    chunks as it needs. ``left`` needs no list. ``project`` picks the
    output from event columns and ``into``. Hand in only the columns of ``dim`` that
    are needed: its size decides how it is joined.
    """
    if matches not in MATCHES:
        raise ValueError(f"matches must be one of {MATCHES}, got {matches!r}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if dim.isStreaming:
        raise ValueError("the lookup table must not be a stream")
    reject_duplicates(dim.columns)
    reject_duplicates([*events.columns, into, *(("chunk",) if matches == "collect" else ())])

    if strategy == "keys":
        dim = referenced_rows(events, dim, key, dim_key, broadcast_limit)
    names = {f"__dim_field_{i}": name for i, name in enumerate(dim.columns)}
    dim_key = quoted(dim_key) if isinstance(dim_key, str) else dim_key
    side = dim.select(
        dim_key.alias(_DIM_KEY), *[quoted(name).alias(field) for field, name in names.items()]
    ).where(F.col(_DIM_KEY).isNotNull())
    keyed = events.withColumn(_KEY, quoted(key) if isinstance(key, str) else key)
    hint = _hint(side, keyed, strategy, broadcast_limit)

    same_key = F.col(_KEY) == F.col(_DIM_KEY)
    extra = []
    if matches == "collect":
        if list_size is not None and (deal is not None or chunks != 1):
            raise ValueError("give either the length of lists, or how rows are dealt into chunks")
        if deal is not None:
            # The caller's names, next to the ones used here.
            side = side.select("*", *[F.col(field).alias(name) for field, name in names.items()])
            side = side.withColumn(_DEAL, deal).drop(*names.values())
        listed = [c for c in side.columns if c != _DIM_KEY]
        if list_size is not None:
            lists = group_values_bounded(side, [_DIM_KEY], listed, _LIST, list_size)
        else:
            lists = group_values(side, [_DIM_KEY], listed, _LIST, chunks, deal if deal is None else F.col(_DEAL))
        if hint != "broadcast":
            # A shuffle of its own, so that an event's hot key can be split here too.
            lists = lists.hint("rebalance")
        joined = keyed.join(_hinted(lists, hint), same_key, "left")
        item = T.StructType([T.StructField(f.name, f.dataType) for f in dim.schema.fields])
        found = F.coalesce(F.col(_LIST), F.array()) if deal is None else F.transform(
            F.coalesce(F.col(_LIST), F.array()), lambda row: row.dropFields(_DEAL)
        )
        match = found.cast(T.ArrayType(item))
        extra = [F.coalesce("chunk", F.lit(0)).alias("chunk")]
    else:
        if matches in ("inner", "left"):
            joined = keyed.join(_hinted(side, hint), same_key, matches)
            values = {name: F.col(field) for field, name in names.items()}
        else:
            joined, found = _join_one(keyed, side, list(names), same_key, hint)
            # The check is a filter, to run whichever columns are asked for. It is
            # in the columns too: a later condition on one of them may be moved
            # before the filter, where it would hide a miss.
            joined = joined.where(_require_one(found, F.lit(True)))
            values = {name: _require_one(found, F.col(field)) for field, name in names.items()}
        match = F.struct(*[value.alias(name) for name, value in values.items()])
        if matches == "left":
            match = F.when(F.col(_DIM_KEY).isNotNull(), match)

    result = joined.select(*[quoted(c) for c in events.columns], *extra, match.alias(into))
    return result if project is None else result.select(*project)


def _hint(rows: DataFrame, events: DataFrame, strategy: str, limit: int) -> str | None:
    """How to join the table. Its rows are measured as they are read: grouping
    them by key later only makes them fewer."""
    if strategy == "merge":
        return "merge"
    if events.isStreaming:
        return None
    return "broadcast" if fits(rows, limit) else "merge"


def _hinted(df: DataFrame, hint: str | None) -> DataFrame:
    return df if hint is None else df.hint(hint)


def _join_one(
    keyed: DataFrame, side: DataFrame, fields: list[str], same_key: Column, hint: str | None
) -> tuple[DataFrame, Column]:
    """Each event with its match, and how many there are, counted by the plan that
    joins: a table that changes meanwhile cannot slip a second match past it."""
    # With one row per key it does not matter that each column is picked on its
    # own, and columns nobody asks for are still pruned from the scan.
    unique = side.groupBy(_DIM_KEY).agg(
        F.count(F.lit(1)).alias(_COUNT), *[F.any_value(field).alias(field) for field in fields]
    )
    if hint != "broadcast" and not _bucketed(side):
        # A shuffle of its own, so that hot keys can be split here too.
        unique = unique.hint("rebalance")
    joined = keyed.join(_hinted(unique, hint), same_key, "left")
    return joined, F.coalesce(F.col(_COUNT), F.lit(0))


def _bucketed(df: DataFrame) -> bool:
    """Whether a table is read by its buckets, which a join can use as they are."""
    return "SelectedBucketsCount" in df._jdf.queryExecution().sparkPlan().toString()


def _require_one(found: Column, value: Column) -> Column:
    """The value if there is one match; else the job fails."""
    message = F.concat(
        F.lit("expected one match for key "),
        F.coalesce(F.col(_KEY).cast("string"), F.lit("NULL")),
        F.lit(", got "),
        found.cast("string"),
    )
    return F.when(found == 1, value).otherwise(F.raise_error(message))


def referenced_rows(
    events: DataFrame,
    dim: DataFrame,
    key: Column | str,
    dim_key: Column | str,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The rows of a lookup table whose key occurs in the events.

    Few keys become an IN list that the table's source evaluates; more of them
    a semi-join, with the keys broadcast if they are within the limit. With still more keys the
    table's rows first pass a Bloom filter of them, within the same limit, so that
    hardly any but those that match are shuffled. The table
    is read once: the rows found are written down for whatever uses them.
    """
    if events.isStreaming:
        raise ValueError("strategy 'keys' needs a bounded input: use it per micro-batch")
    key = quoted(key) if isinstance(key, str) else key
    dim_key = quoted(dim_key) if isinstance(dim_key, str) else dim_key
    keys = events.select(key.alias(_KEY)).where(F.col(_KEY).isNotNull()).distinct()
    return written(_with_keys(dim, dim_key, written(keys, "keys"), broadcast_limit), "referenced")


def _with_keys(dim: DataFrame, dim_key: Column, keys: DataFrame, broadcast_limit: int) -> DataFrame:
    few = [row[0] for row in keys.limit(IN_LIST_LIMIT + 1).collect()]
    if len(few) <= IN_LIST_LIMIT:
        return dim.where(dim_key.isin(few))
    if fits(keys, broadcast_limit):
        return dim.join(F.broadcast(keys), dim_key == F.col(_KEY), "left_semi")
    return rows_with_keys(dim, dim_key, keys, F.col(_KEY), broadcast_limit)


def rows_with_keys(dim: DataFrame, dim_key: Column, keys: DataFrame, key: Column, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The rows of a huge table whose key is among very many distinct ones: pruned by a Bloom filter of
    at most ``limit`` bytes where the table is read, then by a semi-join. Both have to have the same type."""
    bloom = bloom_filter(keys, key, keys.count(), limit)
    if bloom is not None:
        dim = prune(dim, dim_key, bloom)
    return dim.join(keys.hint("merge"), dim_key == key, "left_semi")


def lookup_by_fetch(
    events: DataFrame,
    key: Column | str,
    fetch: Callable[[list], pd.DataFrame],
    schema: str | T.StructType,
    dim_key: str,
    matches: str = "inner",
    batch_size: int = 1_000,
    tasks: int | None = None,
    ordered: bool = False,
    **options,
) -> DataFrame:
    """Lookup join against a store that is asked by key instead of read.

    ``fetch`` gets a list of up to ``batch_size`` distinct keys and returns
    their rows. It runs in the executors, ``tasks`` at a time at most; the events
    themselves never pass through Python. What it returned is written down, so
    no key is asked for twice. With ``ordered`` a list has neighbouring keys, for stores that
    are sorted by key.
    """
    keys = events.select((quoted(key) if isinstance(key, str) else key).alias(_KEY))
    keys = keys.where(F.col(_KEY).isNotNull()).distinct()
    if ordered:
        keys = keys.repartitionByRange(*([] if tasks is None else [tasks]), _KEY).sortWithinPartitions(_KEY)
    elif tasks is not None:
        keys = keys.repartition(tasks, _KEY)

    def full_batches(frames: Iterator[pd.DataFrame]) -> Iterator[list]:
        waiting: list = []
        for frame in frames:
            waiting.extend(frame[_KEY].tolist())
            while len(waiting) >= batch_size:
                yield waiting[:batch_size]
                waiting = waiting[batch_size:]
        if waiting:
            yield waiting

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = (fetch(batch) for batch in full_batches(frames))
        # The columns of an empty frame seldom have the declared types.
        return (rows for rows in found if len(rows))

    fetched = written(keys.mapInPandas(run, schema), "fetched")
    return lookup_join(events, fetched, key, dim_key, matches, **options)
