"""Batch queries over the driver's tables, one or more per operator."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlookup.functions.eventtime import (
    event_millis,
    events_of_window,
    in_window,
    output_millis,
    window_end_millis,
    with_window,
)
from streamlookup.functions.keys import with_uuid
from streamlookup.functions.messages import (
    fields_json,
    json_to_map,
    json_to_struct,
    json_to_variant,
    put_fields,
    put_map,
    row_json,
    row_map,
)
from streamlookup.functions.urls import invalid_urls, url_host
from streamlookup.operators.batching import chunks_for, cogroup_bounded, group_values_bounded, key_batches
from streamlookup.operators.grouping import cogroup, cogroup_aggregate, group_values, tagged_union
from streamlookup.operators.hooks import flat_map_batches, flat_map_elements, map_elements
from streamlookup.operators.latest import latest_per_key
from streamlookup.operators.lookup import lookup_by_fetch, lookup_join, referenced_rows, rows_with_keys
from streamlookup.plans.flows import lookup_compose, lookup_natural_key, lookup_only
from streamlookup.plans.tables import affiliates, events, page_messages, table
from streamlookup.sources.dimensions import dim_rows, read_dim, write_dim
from streamlookup.sources.keyed_files import KeyedFiles, write_keyed
from streamlookup.sources.messages import read_messages, write_messages
from streamlookup.sources.shared import work_folder, written
from streamlookup.sources.versions import read_table, replace_table

WINDOW = "5 minutes"
DAY = datetime(2024, 1, 15, tzinfo=timezone.utc)
CUSTOMER = ["c_custkey", "c_name", "c_mktsegment"]

# Values of a list, about, where a query counts the largest group first to know how many lists it needs.
LIST_ROWS = 1_000


def cents(column: str):
    """Money as whole cents: sums do not depend on the order of the rows."""
    return F.round(F.col(column) * 100).cast("bigint")


def id_list(values: str, field: str):
    """The ids in a list, ordered, as text."""
    ids = F.array_sort(F.transform(F.col(values), lambda v: v[field]))
    return F.array_join(F.transform(ids, lambda v: v.cast("string")), ",")


# URL to host


def host_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_messages(spark, sf_dir).select("page_id", "url", url_host("url").alias("host"))


def host_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_messages(spark, sf_dir).select("page_id", "url", url_host("url", "strict").alias("host"))


def _mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_messages(spark, sf_dir).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "url")
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("url")
    )
    return pages.unionByName(documents)


def host_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed_messages(spark, sf_dir).select("kind", "id", url_host("url", on_invalid="null").alias("host"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invalid_urls(_mixed_messages(spark, sf_dir)).select("kind", "id", F.md5("url").alias("digest"))


# Lookup joins


def lookup_inner(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    dim = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "s_suppkey", strategy=strategy)
    return found.select("event_id", "user_id", "match.s_suppkey", "match.s_name")


def lookup_inner_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_inner(spark, sf_dir, "merge")


def distinct_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_inner(spark, sf_dir, "keys")


def distinct_key_lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys too many for a list: the customers of all orders."""
    dim = table(spark, sf_dir, "customer").select(*CUSTOMER)
    found = lookup_join(table(spark, sf_dir, "orders"), dim, "o_custkey", "c_custkey", "exactly_one", "keys")
    return found.select("o_orderkey", "match.*")


def distinct_key_lookup_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of customers of two segments, found by a Bloom filter of their keys and a semi-join."""
    wanted = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    keys = written(wanted.select("c_custkey").distinct(), "wanted")
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows_with_keys(dim, F.col("o_custkey"), keys, F.col("c_custkey"))


def fetch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's customer, fetched by key from files sorted by it: one fetch for neighbouring keys."""
    folder = work_folder(spark, "customers")
    write_keyed(table(spark, sf_dir, "customer").select(*CUSTOMER), folder, "c_custkey", 16 * 1024)
    fetch = KeyedFiles(folder, "c_custkey", CUSTOMER)
    schema = "c_custkey bigint, c_name string, c_mktsegment string"
    found = lookup_by_fetch(events(spark, sf_dir), "user_id", fetch, schema, "c_custkey", "exactly_one", ordered=True)
    return found.select("event_id", "user_id", "match.*")


def lookup_many(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "o_custkey", strategy=strategy)
    return found.select("event_id", "user_id", "match.o_orderkey", "match.o_totalprice")


def lookup_many_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_many(spark, sf_dir, "merge")


def lookup_exactly_one(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    dim = table(spark, sf_dir, "customer").select(*CUSTOMER)
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "c_custkey", "exactly_one", strategy)
    return found.select("event_id", "user_id", "match.*")


def lookup_exactly_one_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_exactly_one(spark, sf_dir, "merge")


def lookup_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches of every event, a row each, and one for an event without any."""
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "o_custkey", "left")
    return found.select("event_id", "user_id", F.col("match.o_orderkey").alias("order_key"))


def lookup_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many matches every event has, from counts per key."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    found = lookup_join(events(spark, sf_dir), counts, "user_id", "o_custkey", "left")
    return found.select("event_id", F.coalesce("match.n", F.lit(0)).alias("n_matches"))


def lookup_collect_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of matches dealt by the order into chunks of about five per key."""
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    chunks = chunks_for(dim, ["o_custkey"], 5)
    found = lookup_join(
        events(spark, sf_dir), dim, "user_id", "o_custkey", "collect", into="matches", chunks=chunks, deal=F.col("o_orderkey")
    )
    return found.select("event_id", "chunk", F.explode("matches").alias("m"), F.size("matches").cast("bigint").alias("n_matches")).select(
        "event_id", "chunk", "n_matches", "m.o_orderkey"
    )


def lookup_collect_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches of every event out of lists of five at most."""
    dim = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "o_custkey", "collect", into="matches", list_size=5)
    rows = found.select("event_id", (F.size("matches") <= 5).alias("bounded"), F.explode_outer("matches").alias("m"))
    return rows.select("event_id", F.col("m.o_orderkey").alias("order_key"), "bounded")


def lookup_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The caller's own key expression on both sides, and the caller's projection."""
    dim = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return lookup_join(
        events(spark, sf_dir),
        dim,
        key=F.format_string("Supplier#%09d", "user_id"),
        dim_key="s_name",
        project=[
            F.col("event_id"),
            F.upper("match.s_name").alias("supplier"),
            (F.col("match.s_suppkey") + 1).alias("next_key"),
        ],
    )


def lookup_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parameter as a column next to all columns of the match, then dropped from the message."""
    dim = table(spark, sf_dir, "supplier")
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "s_suppkey")
    rows = found.select(F.col("event_id").alias("__key"), "match.*")
    message = rows.drop("__key")
    names = F.array_sort(F.map_keys(row_map(message)))
    return rows.select(
        F.col("__key").alias("event_id"),
        row_map(message)["s_name"].alias("s_name"),
        F.array_join(names, ",").alias("columns"),
    )


def parameter_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality with parameters, evaluated by the table's source."""
    segments = spark.createDataFrame([("BUILDING",), ("MACHINERY",), ("BUILDING",), (None,)], "segment string")
    return referenced_rows(segments, table(spark, sf_dir, "customer"), "segment", "c_mktsegment")


def memory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup table given as rows in memory."""
    weights = dim_rows(spark, [("click", 1), ("view", 2), ("purchase", 50)], "kind string, weight bigint")
    found = lookup_join(events(spark, sf_dir), weights, "event_type", "kind")
    return found.select("event_id", "match.kind", "match.weight")


def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup table loaded into storage and read from there."""
    location = work_folder(spark, "supplier")
    write_dim(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "parquet", location)
    found = lookup_join(events(spark, sf_dir), read_dim(spark, "parquet", location), "user_id", "s_suppkey")
    return found.select("event_id", "user_id", "match.s_suppkey", "match.s_name")


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups in a table that is replaced in between: who began before goes on with the old rows."""
    folder = work_folder(spark, "suppliers")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    replace_table(suppliers, folder)
    old = lookup_join(events(spark, sf_dir), read_table(spark, folder), "user_id", "s_suppkey")
    replace_table(suppliers.where("s_suppkey % 2 = 0").withColumn("s_name", F.upper("s_name")), folder)
    new = lookup_join(events(spark, sf_dir), read_table(spark, folder), "user_id", "s_suppkey")
    both = old.withColumn("version", F.lit(0)).unionByName(new.withColumn("version", F.lit(1)))
    return both.select("version", "event_id", "match.s_name")


# The flows


def lookup_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_only(page_messages(spark, sf_dir), affiliates(spark, sf_dir, 2), "source_domain", keep=["page_id"])


def compose_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_compose(
        page_messages(spark, sf_dir), affiliates(spark, sf_dir), "source_domain",
        columns=["source_domain", "id"], doubles=True, keep=["page_id"],
    )


def natural_key_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_natural_key(
        page_messages(spark, sf_dir), affiliates(spark, sf_dir), "source_domain",
        columns=["source_domain", "id"], doubles=True, keep=["page_id"],
    )


def compose_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_compose(
        events(spark, sf_dir), table(spark, sf_dir, "customer"), "c_custkey", key="user_id",
        columns=CUSTOMER, carry=["event_id", "event_type"], window=WINDOW, keep=["event_id"],
    )


def natural_key_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_natural_key(
        events(spark, sf_dir), table(spark, sf_dir, "customer"), "c_custkey", key="user_id",
        columns=CUSTOMER, carry=["event_id", "event_type"], window=WINDOW, keep=["event_id"],
        latest_only=True, tie_break=["event_id"],
    )


def enrich_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns instead of JSON: the row, and the window's last millisecond."""
    dim = table(spark, sf_dir, "customer").select(*CUSTOMER)
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "c_custkey", "exactly_one")
    return found.select("event_id", "event_type", "match.*", output_millis("ts", WINDOW).alias("timestamp"))


def enrich_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = table(spark, sf_dir, "customer").select(*CUSTOMER)
    found = lookup_join(events(spark, sf_dir), dim, "user_id", "c_custkey", "exactly_one")
    return found.select("event_id", "match.*", output_millis("ts", None).alias("timestamp"))


# Rows, maps and JSON


def row_as_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    entries = F.transform(
        F.array_sort(F.map_entries(row_map(customers))), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return customers.select("c_custkey", F.array_join(entries, ";").alias("fields"))


def row_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return customers.select("c_custkey", row_json(customers).alias("value"))


def merged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields added to a row: one new, one replacing a column."""
    customers = table(spark, sf_dir, "customer")
    base = {c: F.col(c) for c in ("c_custkey", "c_name", "c_nationkey")}
    message = put_fields(base, {"c_name": F.upper("c_name"), "segment": F.col("c_mktsegment")})
    return customers.select("c_custkey", fields_json(message).alias("value"))


def merged_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As merged_json for a map whose names come from the data."""
    props = put_map(json_to_map("props"), {"k": F.lit("replaced"), "user": F.col("user_id")})
    return events(spark, sf_dir).select(
        "event_id", F.size(props).cast("bigint").alias("n_fields"), props["k"].alias("k"), props["user"].alias("user")
    )


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        json_to_struct("props", "k bigint")["k"].alias("typed"),
        json_to_map("props")["k"].alias("text"),
        json_to_map("props", "double")["k"].alias("widened"),
        F.variant_get(json_to_variant("props"), "$.k", "bigint").alias("variant"),
    )


def typed_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a row's map, which are text, read as types; text that does not fit is NULL."""
    orders = table(spark, sf_dir, "orders")
    fields = row_map(orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"))
    number = F.coalesce(fields["o_orderpriority"], F.lit(""))
    return orders.select(
        "o_orderkey",
        fields["o_totalprice"].cast("double").alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, fields["o_orderkey"]).otherwise(number).try_cast("bigint").alias("number"),
        fields["o_orderstatus"].alias("status"),
    )


def random_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys there are, and how many of them are random ones of version 4."""
    keyed = with_uuid(events(spark, sf_dir))
    form = F.col("__key").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    # Keys are counted by groups: one row for each, combined before the shuffle.
    keys = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("n"), F.bool_and(form).alias("well_formed"))
    return keys.agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_events"), F.count_if("well_formed").alias("n_well_formed")
    )


# Event time


def event_time_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", event_millis("ts").alias("millis"))


def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = with_window(events(spark, sf_dir), "ts", WINDOW)
    return windowed.select(
        "event_id",
        F.unix_millis("window.start").alias("window_start"),
        F.unix_millis("window.end").alias("window_end"),
        window_end_millis("window").alias("timestamp"),
    )


def window_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of one day's window, addressed by its start."""
    rows = events_of_window(table(spark, sf_dir, "events"), "ts", timedelta(days=1), DAY)
    return rows.select("event_id", "user_id")


def window_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a windowed query finds for one day's window."""
    windowed = with_window(table(spark, sf_dir, "events"), "ts", "1 day")
    day = in_window(windowed, DAY, ts="ts", size=timedelta(days=1))
    return day.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))


def window_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = with_window(events(spark, sf_dir), "ts", WINDOW)
    grouped = windowed.groupBy("window", "user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(cents("value")).alias("cents")
    )
    return grouped.select(F.unix_millis("window.start").alias("window_start"), "user_id", "n_events", "cents")


def window_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of a user and day, out of as many lists as the largest group needs: a row per value."""
    windowed = with_window(events(spark, sf_dir), "ts", "1 day").select("window", "user_id", "event_id")
    key = ["window", "user_id"]
    grouped = group_values(windowed, key, chunks=chunks_for(windowed, key, LIST_ROWS))
    return grouped.select(
        F.unix_millis("window.start").alias("window_start"), "user_id", F.explode("values").alias("v")
    ).select("window_start", "user_id", "v.event_id")


# Grouping


def group_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its key, out of as many lists as the largest group needs."""
    rows = events(spark, sf_dir).select("user_id", "event_id")
    grouped = group_values(rows, ["user_id"], chunks=chunks_for(rows, ["user_id"], LIST_ROWS))
    return grouped.select("user_id", F.explode("values").alias("v")).select("user_id", "v.event_id")


def group_by_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values a key has: no list, counted before the shuffle."""
    return events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_values"))


def group_by_key_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists dealt by the value into chunks of about 40, and how long each is."""
    rows = events(spark, sf_dir).select("user_id", "event_id")
    grouped = group_values(rows, ["user_id"], chunks=chunks_for(rows, ["user_id"], 40), deal=F.col("event_id"))
    return grouped.select(
        "user_id", "chunk", F.size("values").cast("bigint").alias("n_values"), id_list("values", "event_id").alias("event_ids")
    )


def group_by_key_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its key out of lists of 100 at most, and whether its list keeps to that."""
    grouped = group_values_bounded(events(spark, sf_dir), ["event_type"], ["event_id"], size=100)
    rows = grouped.select("event_type", (F.size("values") <= 100).alias("bounded"), F.explode("values").alias("v"))
    return rows.select("event_type", "v.event_id", "bounded")


def key_batches_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a type in batches of 500: how large each batch is."""
    batched = key_batches(events(spark, sf_dir).select("event_type", "event_id"), ["event_type"], 500)
    return batched.groupBy("event_type", "batch").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_ids")
    )


def key_batches_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, whichever batch of its user it is in, and that batch's size as a client is to be asked with."""
    batched = key_batches(events(spark, sf_dir).select("user_id", "event_id"), ["user_id"], 10)
    size = batched.groupBy("user_id", "batch").agg(F.collect_list("event_id").alias("ids"))
    return size.select("user_id", F.explode("ids").alias("event_id"), (F.size("ids") <= 10).alias("bounded"))


def _both_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    left = events(spark, sf_dir).select(F.col("user_id").alias("key"), "event_id", "value")
    right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_totalprice")
    return left, right


def cogroup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of either side with its key, out of as many lists as the largest group needs."""
    left, right = _both_sides(spark, sf_dir)
    left, right = left.select("key", "event_id"), right.select("key", "o_orderkey")
    chunks = chunks_for(tagged_union(left, right, ["key"]), ["key"], LIST_ROWS)
    return _listed(cogroup(left, right, ["key"], chunks=chunks)).select("key", "v.side", "v.id")


def _listed(both: DataFrame, *columns: Column) -> DataFrame:
    """The values of both lists, a row each."""
    sides = F.concat(
        F.transform("left", lambda v: F.struct(F.lit("event").alias("side"), v["event_id"].alias("id"))),
        F.transform("right", lambda v: F.struct(F.lit("order").alias("side"), v["o_orderkey"].alias("id"))),
    )
    return both.select("key", *columns, F.explode(sides).alias("v"))


def cogroup_lists_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``cogroup_lists``, out of chunks with 20 values of both sides at most."""
    left, right = _both_sides(spark, sf_dir)
    both = cogroup_bounded(left.select("key", "event_id"), right.select("key", "o_orderkey"), ["key"], size=20)
    bounded = (F.size("left") + F.size("right") <= 20).alias("bounded")
    return _listed(both, bounded).select("key", "v.side", "v.id", "bounded")


def cogroup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _both_sides(spark, sf_dir)
    return cogroup_aggregate(
        left,
        right,
        ["key"],
        [
            F.count("left.event_id").alias("n_left"),
            F.count("right.o_orderkey").alias("n_right"),
            F.coalesce(F.sum(cents("left.value")), F.lit(0)).alias("left_cents"),
            F.coalesce(F.sum(cents("right.o_totalprice")), F.lit(0)).alias("right_cents"),
        ],
    )


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    latest = latest_per_key(needed, ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "event_type", event_millis("ts").alias("millis"))


def latest_event_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    windowed = with_window(needed, "ts", "1 day")
    latest = latest_per_key(windowed, ["window", "user_id"], "ts", ["event_id"])
    return latest.select(F.unix_millis("window.start").alias("window_start"), "user_id", "event_id", "event_type")


# Caller's functions


def element_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_elements(events(spark, sf_dir), "event_type", lambda c: F.concat(F.upper(c), F.lit("!")), "label")
    return mapped.select("event_id", "label")


def element_map_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("string")
    def label(kind: pd.Series) -> pd.Series:
        return kind.str.upper() + "!"

    return map_elements(events(spark, sf_dir), "event_type", label, "label").select("event_id", "label")


def element_flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = flat_map_elements(documents, "text", lambda c: F.split(c, "\n"), "line")
    return lines.select("doc_id", F.md5("line").alias("digest"), F.length("line").cast("bigint").alias("n_chars"))


def batch_flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing for a view, one output for other events, two for a purchase."""

    def outputs(batch: pd.DataFrame) -> pd.DataFrame:
        copies = batch["event_type"].map({"view": 0, "purchase": 2}).fillna(1).astype(int)
        out = batch.loc[batch.index.repeat(copies), ["event_id", "event_type"]].reset_index(drop=True)
        return out.assign(output=out.groupby("event_id").cumcount())

    source = events(spark, sf_dir).select("event_id", "event_type")
    return flat_map_batches(source, outputs, "event_id bigint, event_type string, output bigint")


# Messages out and in again


def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "messages")
    write_messages(compose_url(spark, sf_dir), "text", options={"path": folder})
    back = read_messages(spark, "text", {"path": folder}, ts=None, streaming=False)
    fields = json_to_struct("url", "source_domain string, id double, timestamp bigint, url string")
    return back.select(fields.alias("m")).select("m.*")


BATCH_QUERIES = {
    fn.__name__: fn
    for fn in (
        host_extract, host_strict, host_or_null, dead_letters,
        lookup_inner, lookup_inner_merge, distinct_key_lookup, distinct_key_lookup_many,
        distinct_key_lookup_bloom, fetch_lookup, replaced_table, lookup_many, lookup_many_merge,
        lookup_exactly_one, lookup_exactly_one_merge, lookup_collect, lookup_match_counts,
        lookup_collect_chunked, lookup_collect_bounded,
        lookup_hooks, lookup_parameter, parameter_filter, memory_table, table_round_trip,
        lookup_url, compose_url, natural_key_url, compose_window, natural_key_latest, enrich_window, enrich_global,
        row_as_map, row_as_json, merged_json, merged_map, json_parse, typed_access, random_key,
        event_time_millis, window_assign, window_address, window_results, window_group, window_values,
        group_by_key, group_by_key_counts, group_by_key_chunked, group_by_key_bounded,
        key_batches_of_type, key_batches_of_user, cogroup_lists, cogroup_lists_bounded, cogroup_counts, latest_event, latest_event_in_window,
        element_map, element_map_pandas, element_flat_map, batch_flat_map, message_round_trip,
    )
}
