"""Bounded samples that do not depend on how a table is partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LARGEST = 2**63 - 1


def place_of(*columns: str) -> Column:
    """A row's place in an order that its values alone decide, from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def is_among(place: Column, wanted: int, rows: int) -> Column:
    """Whether a place is among the first of ``rows``: about twice as many as ``wanted``,
    so that an exact choice among them has little to send and to compare."""
    share = min(1.0, 2 * wanted / max(rows, 1))
    return place <= F.lit(min(int(share * _LARGEST), _LARGEST))
