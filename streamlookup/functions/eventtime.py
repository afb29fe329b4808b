"""Event time: tumbling windows and the epoch values derived from them."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: epoch milliseconds reported for elements outside any window.
# It lies far beyond the TIMESTAMP range, so it only ever exists as a BIGINT.
GLOBAL_MAX_MILLIS = 9223371950454775


def with_event_time(df: DataFrame, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """Make ``ts`` a TIMESTAMP, and a watermark column when a delay is given.

    Zone-less timestamps are read as UTC (the session zone). The watermark has
    no effect on batch input.
    """
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df if delay is None else df.withWatermark(ts, delay)


def event_millis(ts: Column | str) -> Column:
    """Epoch milliseconds of an event's own time."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))


def window_end_millis(window: Column | str) -> Column:
    """Last millisecond that belongs to a window."""
    window = F.col(window) if isinstance(window, str) else window
    return F.unix_millis(window["end"].cast("timestamp")) - F.lit(1)


def output_millis(ts: Column | str, size: str | None) -> Column:
    """Time stamped on an enriched event: its window's last millisecond, or the
    global maximum when there is no window."""
    if size is None:
        return F.lit(GLOBAL_MAX_MILLIS).cast("bigint")
    ts = F.col(ts) if isinstance(ts, str) else ts
    return window_end_millis(F.window(ts.cast("timestamp"), size))


def with_window(df: DataFrame, ts: str, size: str, into: str = "window") -> DataFrame:
    """Add the tumbling window (struct of ``start`` and ``end``) of every row.
    Rows without a time are in no window and left out.

    A TIMESTAMP column is used as it is: a cast would lose its watermark.
    """
    instant = isinstance(df.schema[ts].dataType, T.TimestampType)
    return df.withColumn(into, F.window(F.col(ts) if instant else F.col(ts).cast("timestamp"), size))


def in_window(
    df: DataFrame, start: datetime, window: str = "window", ts: str | None = None, size: timedelta | None = None
) -> DataFrame:
    """Rows of the window that starts at the given time.

    The window is computed, so nothing outside it is left unread, unless rows still
    have their time: then name its column ``ts`` and the window's ``size``, and its
    range is asked of the source, see :func:`events_of_window`.
    """
    if ts is not None:
        df = events_of_window(df, ts, size, start)
    return df.where(F.col(window)["start"] == F.lit(start))


def events_of_window(df: DataFrame, ts: str, size: timedelta, start: datetime) -> DataFrame:
    """Events of the window that starts at the given time.

    Asks for a range of ``ts`` as it is stored, so that files outside it are not
    read. Zone-less columns are taken as UTC.
    """
    bounds = [start, start + size]
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        bounds = [b.astimezone(timezone.utc).replace(tzinfo=None) if b.tzinfo else b for b in bounds]
        first, end = [F.lit(b.isoformat(" ")).cast("timestamp_ntz") for b in bounds]
    else:
        first, end = [F.lit(b) for b in bounds]
    return df.where((F.col(ts) >= first) & (F.col(ts) < end))
