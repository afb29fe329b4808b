"""The three enrichment flows, each a function from events to JSON messages.

All take batch or streaming events. The lookup key is the host of the event's
URL unless another expression is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import output_millis, window_end_millis, with_window
from streamlookup.functions.messages import fields_json, numbers_as_double, put_fields, quoted
from streamlookup.functions.urls import url_host, with_host
from streamlookup.operators.latest import latest_per_key
from streamlookup.operators.lookup import lookup_join, referenced_rows
from streamlookup.streaming.emission import hold_until_close

EMIT = ("immediate", "on_window_close")


def _valid(events: DataFrame, key: Column | str | None, url: str, on_invalid: str) -> tuple[DataFrame, Column]:
    """The events to look up, and their key. ``drop`` leaves invalid URLs to
    :func:`~streamlookup.functions.urls.invalid_urls`."""
    if on_invalid not in ("fail", "drop"):
        raise ValueError(f"on_invalid must be 'fail' or 'drop', got {on_invalid!r}")
    if key is not None:
        return events, quoted(key) if isinstance(key, str) else key
    if on_invalid == "fail":
        return events, url_host(url)
    return with_host(events, "__host", url), F.col("__host")


def _only(events: DataFrame, names: Sequence[str], key: Column | None = None) -> DataFrame:
    """The named columns an event has, and its key."""
    kept = [quoted(c) for c in dict.fromkeys(names) if c in events.columns]
    return events.select(*kept, *([] if key is None else [key.alias("__event_key")]))


def _required(ts: str) -> Column:
    """An event without a time belongs to no window and would just disappear."""
    missing = F.raise_error(F.lit(f"event without a time in column {ts}"))
    return F.coalesce(quoted(ts).cast("timestamp"), missing.cast("timestamp"))


def lookup_only(
    events: DataFrame,
    dim: DataFrame,
    dim_key: str,
    key: Column | str | None = None,
    url: str = "url",
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    on_invalid: str = "fail",
    **lookup,
) -> DataFrame:
    """The matching row of every event as JSON in ``value``: nothing for a miss,
    a message per match.

    ``columns`` are the row's columns to publish, in order (default all);
    ``keep`` are event columns to carry next to the message, such as a window.
    """
    events, key = _valid(events, key, url, on_invalid)
    columns = list(columns or dim.columns)
    found = lookup_join(events, dim.select(*_with_key(dim, columns, dim_key)), key, dim_key, "inner", **lookup)
    value = fields_json({c: F.col("match")[c] for c in columns})
    return found.select(*[quoted(c) for c in keep], value.alias("value"))


def _with_key(dim: DataFrame, columns: Sequence[str], dim_key: str) -> list[Column]:
    return [quoted(c) for c in dict.fromkeys([*columns, dim_key])]


def lookup_compose(
    events: DataFrame,
    dim: DataFrame,
    dim_key: str,
    key: Column | str | None = None,
    url: str = "url",
    columns: Sequence[str] | None = None,
    carry: Sequence[str] | None = None,
    ts: str = "ts",
    window: str | None = None,
    emit: str = "immediate",
    doubles: bool = False,
    keep: Sequence[str] = (),
    on_invalid: str = "fail",
    **lookup,
) -> DataFrame:
    """The one matching row of every event, with the event's ``timestamp`` and the
    ``carry`` columns (default its URL) added, as JSON in ``value``.

    ``timestamp`` is the last millisecond of the event's window of size
    ``window``, or a constant without windows; ``window_start`` and
    ``window_end`` may be named in ``keep``. An added field replaces a table
    column of its name. The job fails on a miss, on several matches, and with a
    window on an event without a time.
    ``emit='on_window_close'`` holds a stream's events until their window ends.
    ``doubles`` widens numbers as an untyped JSON round trip does.
    """
    if emit not in EMIT:
        raise ValueError(f"emit must be one of {EMIT}, got {emit!r}")
    if emit == "on_window_close" and window is None:
        raise ValueError("emit='on_window_close' needs a window")
    key_is_host = key is None and on_invalid == "fail"
    events, key = _valid(events, key, url, on_invalid)
    columns = list(columns or dim.columns)
    carry = [url] if carry is None else list(carry)
    kept = {c: quoted(c) for c in keep}

    if emit == "on_window_close":
        # Only what the message is made of waits for the window.
        names = [ts, url, *carry, *keep]
        if key_is_host:
            events = _only(events, names)
        else:
            events, key = _only(events, names, key), F.col("__event_key")
        events = hold_until_close(events, ts, window, window="__window")
    elif window is not None:
        events = with_window(events.withColumn(ts, _required(ts)), ts, window, into="__window")
    if window is None:
        stamp = output_millis(ts, None)
    else:
        stamp = window_end_millis("__window")
        bounds = {"window_start": F.col("__window")["start"], "window_end": F.col("__window")["end"]}
        kept = {c: bounds.get(c, column) for c, column in kept.items()}

    published = [c for c in columns if c not in ("timestamp", *carry)]
    found = lookup_join(events, dim.select(*_with_key(dim, published, dim_key)), key, dim_key, "exactly_one", **lookup)
    types = {f.name: f.dataType for f in dim.schema.fields}
    row = {c: F.col("match")[c] for c in published}
    if doubles:
        row = {c: numbers_as_double(value, types[c]) for c, value in row.items()}
    message = put_fields(row, {"timestamp": stamp, **{c: quoted(c) for c in carry}})
    return found.select(*[column.alias(c) for c, column in kept.items()], fields_json(message).alias("value"))


def lookup_natural_key(
    events: DataFrame,
    dim: DataFrame,
    dim_key: str,
    key: Column | str | None = None,
    url: str = "url",
    ts: str = "ts",
    latest_only: bool = False,
    tie_break: Sequence[str] = (),
    on_invalid: str = "fail",
    **compose,
) -> DataFrame:
    """As :func:`lookup_compose`, but every distinct key is looked up once.

    ``latest_only`` first reduces the events to the latest per key. Needs
    bounded events: on a stream call it per micro-batch, see
    :func:`~streamlookup.streaming.batches.enrich_batches`.
    """
    events, key = _valid(events, key, url, on_invalid)
    dim = referenced_rows(events, dim, key, dim_key)
    if latest_only:
        carry = compose.get("carry")
        names = [ts, *tie_break, *([url] if carry is None else carry), *compose.get("keep", ())]
        events = latest_per_key(_only(events, names, key), ["__event_key"], ts, tie_break)
        key = F.col("__event_key")
    return lookup_compose(events, dim, dim_key, key=key, url=url, ts=ts, **compose)
