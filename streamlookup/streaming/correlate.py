"""Two streams joined on a key per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import with_window
from streamlookup.functions.messages import quoted


def correlate(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    how: str = "inner",
    left_name: str = "left",
    right_name: str = "right",
    window: str = "window",
    emit: str = "immediate",
    parts: int = 32,
) -> DataFrame:
    """Pairs of rows with the same keys in the same window: the keys, the window, and a struct per side.

    On streams both sides need a watermark on ``ts``. Each waits in state for the other's rows; when the
    smaller of the two watermarks passes the end of a window its rows leave the state, and with ``how``
    ``left_outer``, ``right_outer`` or ``full_outer`` rows without a partner come out then. NULL keys match nothing. Meant
    for keys that are unique or nearly so, such as the id of an event: all pairs of a key come out.

    With ``emit='on_window_close'`` streams wait as lists, ``parts`` of each window by the hash of the keys, and all
    pairs of a window come out when it closes: the state has a row per list instead of two per event. A
    row is compared with all of the other side in its part, so give as many parts as leave some dozens of rows to
    each. The number belongs to the checkpoint. Batch input gives the same rows either way.
    """
    if emit not in ("immediate", "on_window_close"):
        raise ValueError(f"emit must be 'immediate' or 'on_window_close', got {emit!r}")
    if how not in ("inner", "left_outer", "right_outer", "full_outer") and emit == "on_window_close":
        raise ValueError(f"rows cannot wait for a {how} join")

    def side(df: DataFrame, name: str) -> tuple[DataFrame, list[str], str]:
        made = [f"__{name}_{i}" for i in range(len(keys))]
        windowed = with_window(df, ts, size, f"__{name}_window")
        values = [quoted(c) for c in df.columns if c not in keys]
        columns = [*[quoted(k).alias(m) for k, m in zip(keys, made)], F.col(f"__{name}_window"), F.struct(*values).alias(name)]
        return windowed.select(*columns), made, f"__{name}_window"

    (a, a_keys, a_window), (b, b_keys, b_window) = side(left, left_name), side(right, right_name)
    if emit == "on_window_close" and left.isStreaming and right.isStreaming:
        sides = [a.toDF(*_names(len(keys))), b.toDF(*_names(len(keys)))]
        found = _pairs_on_close(*sides, len(keys), how, parts)
        names = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
        return found.select(*names, F.col("w").alias(window), F.col("l").alias(left_name), F.col("r").alias(right_name))
    same = [F.col(x) == F.col(y) for x, y in zip([*a_keys, a_window], [*b_keys, b_window])]
    joined = a.join(b, same, how)
    found = [F.coalesce(F.col(x), F.col(y)).alias(k) for x, y, k in zip(a_keys, b_keys, keys)]
    # A column as it is keeps its watermark; only an outer join on the left lacks it.
    first = F.col(a_window) if how in ("inner", "left_outer") else F.col(b_window) if how == "right_outer" else F.coalesce(a_window, b_window)
    return joined.select(*found, first.alias(window), F.col(left_name), F.col(right_name))


def _names(n: int) -> list[str]:
    return [*[f"k{i}" for i in range(n)], "w", "row"]


def _pairs_on_close(left: DataFrame, right: DataFrame, n: int, how: str, parts: int) -> DataFrame:
    """Pairs of two streams of :func:`_names`, held as lists of both sides per window and part."""
    keys = [f"k{i}" for i in range(n)]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()

    def tagged(df: DataFrame, is_left: bool, alone: bool) -> DataFrame:
        # A row without a key has no partner: it waits only if it comes out by itself.
        df = df if alone else df.where(~no_key)
        part = F.pmod(F.xxhash64(*keys), F.lit(parts))
        return df.select("w", part.alias("part"), F.lit(is_left).alias("is_left"), F.struct(*keys).alias("k"), *[
            (F.col("row") if is_left == own else F.lit(None)).alias(name) for name, own in (("l", True), ("r", False))])

    a, b = tagged(left, True, how in ("left_outer", "full_outer")), tagged(right, False, how in ("right_outer", "full_outer"))
    both = a.unionByName(b)

    def listed(is_left: bool, name: str) -> Column:
        return F.collect_list(F.when(F.col("is_left") == is_left, F.struct("k", name))).alias(f"{name}s")

    kept = both.groupBy("w", "part").agg(listed(True, "l"), listed(False, "r"))

    def equal(x: Column, y: Column) -> Column:
        # Key by key, as a comparison of structs takes NULLs for equal.
        same = F.lit(True)
        for k in keys:
            same = same & (x["k"][k] == y["k"][k])
        return F.coalesce(same, F.lit(False))

    kinds = {f.name: f.dataType for f in both.schema.fields}
    none = {name: F.lit(None).cast(kinds[name]) for name in ("l", "r")}

    def partners(x: Column) -> Column:
        found = F.transform(F.filter("rs", lambda y: equal(x, y)), lambda y: F.struct(x["k"].alias("k"), x["l"].alias("l"), y["r"].alias("r")))
        if how in ("inner", "right_outer"):
            return found
        alone = F.array(F.struct(x["k"].alias("k"), x["l"].alias("l"), none["r"].alias("r")))
        return F.when(F.size(found) == 0, alone).otherwise(found)

    pairs = F.flatten(F.transform("ls", partners))
    if how in ("right_outer", "full_outer"):
        rest = F.filter("rs", lambda y: ~F.exists("ls", lambda x: equal(x, y)))
        pairs = F.concat(pairs, F.transform(rest, lambda y: F.struct(y["k"].alias("k"), none["l"].alias("l"), y["r"].alias("r"))))
    return kept.select("w", F.explode(pairs).alias("pair")).select(*[F.col("pair.k")[k].alias(k) for k in keys], "w", "pair.l", "pair.r")
