"""The four cases of each flow, on their golden messages."""

from __future__ import annotations

import pytest
from conftest import instant
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import in_window, with_event_time, with_window
from streamlookup.plans.flows import lookup_compose, lookup_natural_key, lookup_only
from streamlookup.plans.jobs import FLOWS as JOBS
from streamlookup.plans.jobs import publish
from streamlookup.sources.messages import message_rows
from streamlookup.streaming.batches import enrich_batches, to_folder
from streamlookup.streaming.replay import replay, run_available

# Inputs and expected messages.
MEDIUM = "http://www.medium.com"
BLOGSPOT = "https://www.blogspot.com"
FLOW_1 = {
    MEDIUM: '{"source_domain":"www.medium.com","compensation":0.01,"id":2}',
    BLOGSPOT: '{"source_domain":"www.blogspot.com","compensation":0.03,"id":1}',
}
GLOBAL = {
    MEDIUM: '{"source_domain":"www.medium.com","id":2.0,"timestamp":9223371950454775,"url":"http://www.medium.com"}',
    BLOGSPOT: (
        '{"source_domain":"www.blogspot.com","id":1.0,"timestamp":9223371950454775,"url":"https://www.blogspot.com"}'
    ),
}
WINDOWED = {
    MEDIUM: '{"source_domain":"www.medium.com","id":2.0,"timestamp":299999,"url":"http://www.medium.com"}',
    BLOGSPOT: '{"source_domain":"www.blogspot.com","id":1.0,"timestamp":599999,"url":"https://www.blogspot.com"}',
}
FIVE_MINUTES = 300_000


def flow_1(events, dim, **options):
    return lookup_only(events, dim, "source_domain", columns=["source_domain", "compensation", "id"], **options)


def flow_2(events, dim, **options):
    return lookup_compose(events, dim, "source_domain", columns=["source_domain", "id"], doubles=True, **options)


def flow_3(events, dim, **options):
    return lookup_natural_key(events, dim, "source_domain", columns=["source_domain", "id"], doubles=True, **options)


FLOWS = [(flow_1, FLOW_1), (flow_2, GLOBAL), (flow_3, GLOBAL)]


def values(df):
    return sorted(r["value"] for r in df.collect())


@pytest.mark.parametrize("flow, expected", FLOWS)
@pytest.mark.parametrize("urls", [[MEDIUM], [MEDIUM, BLOGSPOT]], ids=["one", "two"])
def test_bounded(spark, affiliate, flow, expected, urls):
    assert values(flow(message_rows(spark, urls), affiliate)) == sorted(expected[u] for u in urls)


@pytest.fixture
def script(message_files):
    """One event in each of two windows, then an event that closes them."""
    message_files.add((MEDIUM, 0))
    message_files.add((BLOGSPOT, 360_000))
    return message_files


def test_stream_flow_1(spark, affiliate, script, tmp_path):
    windowed = with_window(with_event_time(script.stream(), delay="0 seconds"), "ts", "5 minutes")
    out = replay(spark, flow_1(windowed, affiliate, keep=["window"]), str(tmp_path / "work"))
    assert values(out) == sorted(FLOW_1.values())
    assert values(in_window(out, instant(0))) == [FLOW_1[MEDIUM]]
    assert values(in_window(out, instant(FIVE_MINUTES))) == [FLOW_1[BLOGSPOT]]


@pytest.mark.parametrize("emit", ["immediate", "on_window_close"])
def test_stream_flow_2(spark, affiliate, script, tmp_path, emit):
    script.add((MEDIUM, 5_000_000))  # its own window stays open, or is dropped below
    events = with_event_time(script.stream(), delay="0 seconds")
    composed = flow_2(events, affiliate, window="5 minutes", emit=emit, keep=["window_start"])
    out = replay(spark, composed, str(tmp_path / "work")).where(F.col("window_start") < F.lit(instant(600_000)))
    assert values(out) == sorted(WINDOWED.values())
    assert values(out.where(F.col("window_start") == F.lit(instant(0)))) == [WINDOWED[MEDIUM]]
    assert values(out.where(F.col("window_start") == F.lit(instant(FIVE_MINUTES)))) == [WINDOWED[BLOGSPOT]]


@pytest.mark.parametrize("latest_only", [False, True])
def test_stream_flow_3(spark, affiliate, script, tmp_path, latest_only):
    def enrich(batch):
        return flow_3(batch, affiliate, window="5 minutes", keep=["window_start"], latest_only=latest_only)

    writer = enrich_batches(script.stream(), enrich, to_folder(str(tmp_path / "out")), str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert values(out) == sorted(WINDOWED.values())
    assert values(out.where(F.col("window_start") == F.lit(instant(0)))) == [WINDOWED[MEDIUM]]


def test_a_restart_emits_nothing_twice(spark, affiliate, script, tmp_path):
    composed = flow_2(script.stream(), affiliate, window="5 minutes")
    for _ in range(2):
        run_available(composed, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    script.add((BLOGSPOT, 360_000))
    run_available(composed, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert values(out) == sorted([WINDOWED[MEDIUM], WINDOWED[BLOGSPOT], WINDOWED[BLOGSPOT]])


@pytest.mark.parametrize("per_batch", [False, True])
@pytest.mark.parametrize("flow", JOBS)
def test_from_source_to_sink(spark, affiliate, script, tmp_path, flow, per_batch):
    columns = ["source_domain", "compensation", "id"] if flow == "lookup_only" else ["source_domain", "id"]
    options = {"columns": columns} if flow == "lookup_only" else {"columns": columns, "doubles": True}
    expected = FLOW_1 if flow == "lookup_only" else GLOBAL
    sink, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    writer = publish(
        flow, script.stream(), lambda: affiliate, "source_domain", "text", {"path": sink}, checkpoint,
        per_batch=per_batch, **options,
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    assert values(spark.read.text(sink)) == sorted(expected.values())

    if flow != "lookup_only":
        with pytest.raises(ValueError, match="emits at once"):
            publish(
                flow, script.stream(), affiliate, "source_domain", "text", {"path": sink}, checkpoint,
                per_batch=True, emit="on_window_close", window="5 minutes",
            )

    bounded = str(tmp_path / "bounded")
    events = message_rows(spark, [MEDIUM, BLOGSPOT])
    assert publish(flow, events, affiliate, "source_domain", "text", {"path": bounded}, **options) is None
    assert values(spark.read.text(bounded)) == sorted(expected.values())
