"""Groups cut into batches of a bounded size, however many rows a key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlookup.functions.messages import quoted, reject_duplicates
from streamlookup.operators.grouping import tagged_union
from streamlookup.sources.shared import written

# Rows of a batch, and of a list, unless a caller says otherwise.
BATCH_ROWS = 500

# Consecutive rows of a stored file that are ranked together; bounds a sort.
BLOCK_ROWS = 50_000


def chunks_for(df: DataFrame, keys: Sequence[str], size: int) -> int:
    """How many chunks of about ``size`` rows the largest group needs. Rows are counted before the
    shuffle, and one number reaches the driver."""
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 1
    return -(-most // size)


def rank_in_key(df: DataFrame, keys: Sequence[str], into: str = "rank", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number the rows of each key from 0, in no particular order, without a gap.

    The rows are stored, which gives each a fixed place. A row's rank is what earlier blocks of
    ``block_rows`` stored rows have of its key, by counts, plus its rank inside its block. So a
    key is ranked by as many tasks as it has blocks, and none of them sorts more than a block. NULL is a key
    like any other. A column named like ``into`` is an error; an empty table stays empty.
    """
    if df.isStreaming:
        raise ValueError("ranks within a key need a bounded input")
    reject_duplicates([*df.columns, into])
    named = {f"c{i}": c for i, c in enumerate(df.columns)}
    key = [next(k for k, c in named.items() if c == wanted) for wanted in keys]
    stored = written(df.toDF(*named), "ranked").select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.floor(F.col("_metadata.row_index") / block_rows).alias("_block"),
        F.col("_metadata.row_index").alias("_row"),
    )
    block = [*key, "_file", "_block"]
    counts = written(stored.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    before = Window.partitionBy(*key).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        *[F.col(c).alias(f"_{c}") for c in block], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    inside = stored.withColumn("_inside", F.row_number().over(Window.partitionBy(*block).orderBy("_row")) - 1)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in block]
    ranked = inside.join(bases.hint("merge"), same)
    return ranked.select(*[F.col(k).alias(c) for k, c in named.items()], (F.col("_base") + F.col("_inside")).alias(into))


def key_batches(df: DataFrame, keys: Sequence[str], size: int = BATCH_ROWS, into: str = "batch") -> DataFrame:
    """Add the number of a batch, from 0 per key, to each row.

    A batch has ``size`` rows of one key, the last one of a key what is left: a key of n
    rows makes ceil(n / size) batches, each of which fits in a task and can be asked or
    sent at once. Every row is in exactly one. See :func:`rank_in_key`.
    """
    if size < 1:
        raise ValueError(f"a batch needs a row at least, got {size}")
    reject_duplicates([*df.columns, into])
    ranked = rank_in_key(df, keys, "__rank")
    return ranked.withColumn(into, F.floor(F.col("__rank") / size)).drop("__rank")


def group_values_bounded(
    df: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None, into: str = "values", size: int = BATCH_ROWS
) -> DataFrame:
    """All values of each key as lists of at most ``size`` structs: the keys, ``chunk`` (from 0) and the list.

    Unlike ``group_values`` the bound holds whatever the sizes of the groups, and without anybody saying
    how many lists a key needs.
    """
    values = list(values or [c for c in df.columns if c not in keys])
    rows = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *values])])
    batched = key_batches(rows, keys, size, "chunk")
    item = F.struct(*[quoted(v) for v in values])
    return batched.groupBy(*[quoted(k) for k in keys], "chunk").agg(F.collect_list(item).alias(into))


def cogroup_bounded(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_name: str = "left",
    right_name: str = "right",
    size: int = BATCH_ROWS,
) -> DataFrame:
    """Per key the left and the right values, in chunks of at most ``size`` rows of both sides together.

    Keys found on one side only are kept, with an empty list for the other, and so is a side's list in
    chunks that have rows of the other only.
    """
    both = key_batches(tagged_union(left, right, keys, left_name, right_name), keys, size, "chunk")
    lists = [F.collect_list(quoted(name)).alias(name) for name in (left_name, right_name)]
    return both.groupBy(*[quoted(k) for k in keys], "chunk").agg(*lists)
