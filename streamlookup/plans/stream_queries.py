"""Streaming queries over the driver's tables.

Each reads its table as a stream, runs to the end of the input, and returns what
the sink received. The results equal those of the batch query of the same name.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import (
    event_millis,
    events_of_window,
    in_window,
    output_millis,
    with_event_time,
    with_window,
)
from streamlookup.functions.messages import json_to_struct
from streamlookup.operators.batching import chunks_for
from streamlookup.operators.grouping import cogroup, group_values
from streamlookup.operators.latest import latest_per_key
from streamlookup.operators.lookup import lookup_join
from streamlookup.plans.batch_queries import CUSTOMER, DAY, LIST_ROWS, WINDOW, cents
from streamlookup.plans.flows import lookup_compose, lookup_natural_key, lookup_only
from streamlookup.plans.tables import (
    affiliates,
    event_stream,
    events as stored_events,
    files_of,
    ordered_event_stream,
    page_stream,
    stored_bytes,
    table,
)
from streamlookup.sources.messages import read_messages, write_messages
from streamlookup.sources.shared import work_folder
from streamlookup.streaming.batches import enrich_batches, to_folder
from streamlookup.streaming.correlate import correlate
from streamlookup.streaming.emission import hold_until_close
from streamlookup.streaming.late import mark_late, split_late
from streamlookup.streaming.latest import compact_latest, read_latest, running_latest
from streamlookup.streaming.replay import files_in_turn, replay, replay_windows, stream_table

DELAY = "10 minutes"
FIVE_MINUTES = timedelta(minutes=5)
DAY_LONG = timedelta(days=1)

# Events of a window that wait together for the other stream's.
PART_ROWS = 50


def stream_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = lookup_join(event_stream(spark, sf_dir), dim, "user_id", "s_suppkey")
    result = found.select("event_id", "user_id", "match.s_suppkey", "match.s_name")
    return replay(spark, result, work_folder(spark, "lookup_inner"))


def stream_lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    found = lookup_join(event_stream(spark, sf_dir), dim, "user_id", "o_custkey")
    result = found.select("event_id", "user_id", "match.o_orderkey", "match.o_totalprice")
    return replay(spark, result, work_folder(spark, "lookup_many"))


def stream_lookup_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lookup_only(
        page_stream(spark, sf_dir), affiliates(spark, sf_dir, 2), "source_domain", keep=["page_id"]
    )
    return replay(spark, result, work_folder(spark, "lookup_url"))


def stream_enrich_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "customer").select(*CUSTOMER)
    found = lookup_join(event_stream(spark, sf_dir), dim, "user_id", "c_custkey", "exactly_one")
    result = found.select("event_id", "event_type", "match.*", output_millis("ts", WINDOW).alias("timestamp"))
    return replay(spark, result, work_folder(spark, "enrich_window"))


def _compose(events: DataFrame, dim: DataFrame, emit: str) -> DataFrame:
    return lookup_compose(
        events, dim, "c_custkey", key="user_id", columns=CUSTOMER, carry=["event_id", "event_type"],
        window=WINDOW, emit=emit, keep=["event_id"],
    )


def stream_compose_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _compose(event_stream(spark, sf_dir), table(spark, sf_dir, "customer"), "immediate")
    return replay(spark, result, work_folder(spark, "compose_window"))


def stream_compose_on_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, each held back until its window has ended.

    One stream holds the events and writes them when their window closes; another,
    without state, looks them up, where hot keys are split.
    """
    events = ordered_event_stream(spark, sf_dir).select("event_id", "event_type", "user_id", "ts")
    folder = work_folder(spark, "compose_on_close")

    def hold(rows: DataFrame) -> DataFrame:
        return hold_until_close(rows, "ts", WINDOW).drop("window")

    held = replay_windows(spark, events, hold, folder, DELAY, FIVE_MINUTES)
    closed = stream_table(spark, f"{folder}/out", held.schema)
    return replay(spark, _compose(closed, table(spark, sf_dir, "customer"), "immediate"), f"{folder}/composed")


def stream_window_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        windowed = with_window(events, "ts", WINDOW)
        return (
            windowed.groupBy("window", "user_id")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(cents("value")).alias("cents"))
            .select(F.unix_millis("window.start").alias("window_start"), "user_id", "n_events", "cents")
        )

    events = ordered_event_stream(spark, sf_dir).select("ts", "user_id", "value")
    return replay_windows(spark, events, build, work_folder(spark, "window_group"), DELAY, FIVE_MINUTES)


def _chunks_of_day(spark: SparkSession, sf_dir: str) -> int:
    """How many parts the values of a user and day need; on a stream without an end, give the peak's."""
    rows = with_window(stored_events(spark, sf_dir), "ts", "1 day")
    return chunks_for(rows, ["window", "user_id"], LIST_ROWS)


def stream_window_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value lists in as many parts per key as the largest needs, put together again afterwards."""
    chunks = _chunks_of_day(spark, sf_dir)

    def build(events: DataFrame) -> DataFrame:
        windowed = with_window(events, "ts", "1 day")
        grouped = group_values(windowed, ["window", "user_id"], ["event_id"], chunks=chunks)
        return grouped.select(F.unix_millis("window.start").alias("window_start"), "user_id", "chunk", "values")

    events = ordered_event_stream(spark, sf_dir).select("ts", "user_id", "event_id")
    parts = replay_windows(spark, events, build, work_folder(spark, "window_values"), DELAY, DAY_LONG)
    return parts.select("window_start", "user_id", F.explode("values").alias("v")).select(
        "window_start", "user_id", "v.event_id"
    )


def stream_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and all other events of a user and day, in as many parts as the largest group needs."""
    chunks = _chunks_of_day(spark, sf_dir)

    def build(events: DataFrame) -> DataFrame:
        windowed = with_window(events, "ts", "1 day")
        purchase = F.col("event_type") == "purchase"
        keyed = windowed.select("window", "user_id", "event_id", "event_type")
        both = cogroup(
            keyed.where(purchase).drop("event_type"),
            keyed.where(~purchase).drop("event_type"),
            ["window", "user_id"],
            chunks=chunks,
        )
        sides = F.concat(
            F.transform("left", lambda v: F.struct(F.lit("purchase").alias("side"), v["event_id"].alias("event_id"))),
            F.transform("right", lambda v: F.struct(F.lit("other").alias("side"), v["event_id"].alias("event_id"))),
        )
        rows = both.select("window", "user_id", F.explode(sides).alias("v"))
        return rows.select(F.unix_millis("window.start").alias("window_start"), "user_id", "v.side", "v.event_id")

    events = ordered_event_stream(spark, sf_dir).select("ts", "user_id", "event_id", "event_type")
    return replay_windows(spark, events, build, work_folder(spark, "cogroup"), DELAY, DAY_LONG)


def stream_window_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a windowed stream finds for one day's window; other files are not read."""

    def build(events: DataFrame) -> DataFrame:
        windowed = with_window(events, "ts", "1 day")
        counts = windowed.groupBy("window", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
        return in_window(counts, DAY).select("event_type", "n_events")

    events = events_of_window(ordered_event_stream(spark, sf_dir), "ts", DAY_LONG, DAY)
    return replay_windows(spark, events.select("ts", "event_type"), build, work_folder(spark, "results"), DELAY, DAY_LONG)


def _late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in five micro-batches: four quarters in the order of time, and every fiftieth after all others."""
    rows = table(spark, sf_dir, "events")
    late, n = F.col("event_id") % 50 == 7, rows.count()
    quarter = F.least(F.floor(F.col("event_id") * 4 / F.lit(n)), F.lit(3))
    parts = [*[rows.where(~late & (quarter == i)) for i in range(4)], rows.where(late)]
    files = files_of(stored_bytes(rows), len(parts))
    folder = files_in_turn(parts, work_folder(spark, "late_events"), files)
    return with_event_time(stream_table(spark, folder, rows.schema, files))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted per window when every fiftieth comes after all others.

    The late ones are left out, but for those whose window is still open. Spark
    compares them with the watermark of the micro-batch before the last: the
    greatest time of the first three quarters, less the delay.
    """

    def build(marked: DataFrame) -> DataFrame:
        counts = with_window(marked, "ts", WINDOW).groupBy("window").agg(F.count(F.lit(1)).alias("n_events"))
        return counts.select(F.unix_millis("window.start").alias("window_start"), "n_events")

    events = _late_events(spark, sf_dir).select("ts")
    work = work_folder(spark, "late_rows")
    return replay_windows(spark, events, build, work, DELAY, FIVE_MINUTES, allow_late=True)


def stream_late_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with whether it was late, out of two folders that a stream wrote: none is dropped."""
    events = with_event_time(_late_events(spark, sf_dir).select("event_id", "ts"), delay=DELAY)
    folder = work_folder(spark, "late_side")
    writer = split_late(mark_late(events, "ts", WINDOW), f"{folder}/in_time", f"{folder}/late", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    sides = [
        spark.read.schema("event_id bigint").parquet(f"{folder}/{side}").select("event_id", F.lit(side == "late").alias("late"))
        for side in ("in_time", "late")
    ]
    return sides[0].unionByName(sides[1])


def stream_correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams of one event each, its type and its value, joined on its id in its window."""
    parts = chunks_for(with_window(stored_events(spark, sf_dir), "ts", WINDOW), ["window"], PART_ROWS)

    def build(events: DataFrame) -> DataFrame:
        types = events.select("event_id", "ts", "event_type")
        values = events.select("event_id", "ts", cents("value").alias("cents"))
        both = correlate(types, values, ["event_id"], "ts", WINDOW, emit="on_window_close", parts=parts)
        return both.select("event_id", "left.event_type", "right.cents", F.unix_millis("window.start").alias("window_start"))

    events = ordered_event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    return replay_windows(spark, events, build, work_folder(spark, "correlated"), DELAY, FIVE_MINUTES)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of every user over the whole stream, after a restart and a compaction."""
    events = ordered_event_stream(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    folder = work_folder(spark, "running_latest")
    for _ in range(2):
        writer = running_latest(events, ["user_id"], f"{folder}/out", f"{folder}/checkpoint", tie_break=["event_id"])
        writer.trigger(availableNow=True).start().awaitTermination()
    compact_latest(spark, f"{folder}/out", events.schema, ["user_id"])
    latest = read_latest(spark, f"{folder}/out", events.schema, ["user_id"])
    return latest.select("user_id", "event_id", "event_type", event_millis("ts").alias("millis"))


def stream_latest_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        windowed = with_window(events, "ts", "1 day")
        latest = latest_per_key(windowed, ["window", "user_id"], "ts", ["event_id"])
        return latest.select(F.unix_millis("window.start").alias("window_start"), "user_id", "event_id", "event_type")

    events = ordered_event_stream(spark, sf_dir).select("ts", "user_id", "event_id", "event_type")
    return replay_windows(spark, events, build, work_folder(spark, "latest"), DELAY, DAY_LONG)


def stream_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch, the table's rows for the distinct hosts of its URLs."""
    dim = affiliates(spark, sf_dir)
    folder = work_folder(spark, "natural_key")

    def enrich(batch: DataFrame) -> DataFrame:
        return lookup_natural_key(
            batch, dim, "source_domain", columns=["source_domain", "id"], doubles=True, keep=["page_id"]
        )

    writer = enrich_batches(page_stream(spark, sf_dir), enrich, to_folder(f"{folder}/out"), f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("page_id", "value")


def stream_message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "stream_messages")
    messages = lookup_compose(
        page_stream(spark, sf_dir), affiliates(spark, sf_dir), "source_domain",
        columns=["source_domain", "id"], doubles=True,
    )
    writer = write_messages(messages, "text", options={"path": f"{folder}/out"}, checkpoint=f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    back = read_messages(spark, "text", {"path": f"{folder}/out"}, ts=None)
    fields = json_to_struct("url", "source_domain string, id double, timestamp bigint, url string")
    return replay(spark, back.select(fields.alias("m")).select("m.*"), f"{folder}/again")


def stream_event_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = event_stream(spark, sf_dir).select("event_id", event_millis("ts").alias("millis"))
    return replay(spark, result, work_folder(spark, "event_millis"))


STREAM_QUERIES = {
    fn.__name__: fn
    for fn in (
        stream_lookup_inner, stream_lookup_many, stream_lookup_url, stream_enrich_window, stream_compose_window,
        stream_compose_on_close, stream_window_group, stream_window_values, stream_window_results, stream_cogroup,
        stream_late_rows, stream_late_side, stream_correlated, stream_latest_in_window, stream_latest,
        stream_natural_key, stream_message_round_trip, stream_event_millis,
    )
}
