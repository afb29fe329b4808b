"""Latest event per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.functions.messages import quoted


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``ts`` of each key; ties go to the greatest
    ``tie_break`` values.

    Each task keeps one row per key before anything is shuffled. All columns
    handed in are read and carried along, so select the needed ones first. On a
    stream put a window column among the keys and a watermark on ``ts``.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[quoted(c) for c in [ts, *tie_break]])
    latest = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(F.struct(*[quoted(c) for c in others]), order).alias("__latest")
    )
    return latest.select(*[quoted(c) if c in keys else F.col("__latest")[c].alias(c) for c in df.columns])
