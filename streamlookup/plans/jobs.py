"""A flow from a message source to a message sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from streamlookup.functions.eventtime import with_event_time
from streamlookup.functions.urls import invalid_urls
from streamlookup.plans.flows import lookup_compose, lookup_natural_key, lookup_only
from streamlookup.sources.messages import write_messages
from streamlookup.streaming.batches import enrich_batches, to_messages

FLOWS = {"lookup_only": lookup_only, "lookup_compose": lookup_compose, "lookup_natural_key": lookup_natural_key}


def publish(
    flow: str,
    events: DataFrame,
    dim: DataFrame | Callable[[], DataFrame],
    dim_key: str,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str | None = None,
    delay: str | None = None,
    per_batch: bool = False,
    **flow_options,
) -> DataStreamWriter | None:
    """Enrich messages by one of the flows and publish the result.

    Bounded events are published at once. For a stream the writer is returned,
    to be given a trigger and started. ``delay`` sets the watermark for
    ``emit='on_window_close'``. With ``per_batch`` each micro-batch is enriched
    as a batch job; then ``dim`` may be a function that reads the table, to see
    its rows as they are now. ``lookup_natural_key`` always runs that way.

    A job over bounded events, be it a micro-batch, asks a table given as a function
    only for the rows its distinct keys refer to, and copies those: all steps of a
    lookup see the same rows, though the table changes meanwhile, and it is never
    read whole. A stream without ``per_batch`` reads it in every micro-batch.
    """
    enrich = FLOWS[flow]
    batches = events.isStreaming and (per_batch or flow == "lookup_natural_key")
    if batches and checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    if batches and flow_options.get("emit") == "on_window_close":
        raise ValueError("a window may last longer than the micro-batch: per_batch emits at once")

    current = dim if callable(dim) else lambda: dim
    bounded = batches or not events.isStreaming
    if callable(dim) and bounded and flow != "lookup_natural_key":  # which asks by key anyway
        flow_options.setdefault("strategy", "keys")
    if batches:
        return enrich_batches(
            events,
            lambda batch: enrich(batch, current(), dim_key, **flow_options),
            to_messages(fmt, options),
            checkpoint,
        )
    if delay is not None:
        events = with_event_time(events, delay=delay)
    messages = enrich(events, current(), dim_key, **flow_options)
    return write_messages(messages, fmt, options=options, checkpoint=checkpoint)


def publish_invalid(
    events: DataFrame, fmt: str, options: Mapping[str, str], checkpoint: str | None = None, url: str = "url"
) -> DataStreamWriter | None:
    """Publish the URLs that ``on_invalid='drop'`` leaves out, to a dead-letter sink.

    Bounded events are published at once; for a stream the writer of a query of its
    own is returned, which needs its own checkpoint.
    """
    return write_messages(invalid_urls(events, url), fmt, url, options, checkpoint)
