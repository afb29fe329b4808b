from __future__ import annotations

from collections import Counter

import pandas as pd
import pytest
from conftest import AFFILIATE
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import streamlookup.operators.lookup as lookup
from streamlookup.functions.urls import url_host
from streamlookup.operators.lookup import lookup_by_fetch, lookup_join, referenced_rows
from streamlookup.operators.sizing import fits
from streamlookup.plans.flows import lookup_compose, lookup_only
from streamlookup.sources.dimensions import dim_rows, read_dim, write_dim
from streamlookup.sources.messages import message_rows

MEDIUM = "http://www.medium.com/a"
UNKNOWN = "http://unknown.example/"
STRATEGIES = ["auto", "merge", "keys"]


def plan(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def join(events, dim, matches, strategy="auto", **options):
    return lookup_join(events, dim, url_host("url"), "source_domain", matches, strategy, **options)


@pytest.fixture
def doubled(spark, affiliate):
    """Two rows for one host, and two for a host no event refers to."""
    more = [(3, "www.medium.com", None), (4, "www.other.com", 0.1), (5, "www.other.com", 0.2)]
    return affiliate.unionByName(dim_rows(spark, more, AFFILIATE))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_inner_drops_misses_and_multiplies(spark, doubled, strategy):
    found = join(message_rows(spark, [MEDIUM, MEDIUM, UNKNOWN]), doubled, "inner", strategy)
    assert Counter(r["match"]["id"] for r in found.collect()) == {2: 2, 3: 2}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_collect_keeps_misses(spark, doubled, strategy):
    found = join(message_rows(spark, [MEDIUM, UNKNOWN]), doubled, "collect", strategy).collect()
    ids = {r["url"]: sorted(m["id"] for m in r["match"]) for r in found}
    assert ids == {MEDIUM: [2, 3], UNKNOWN: []}
    assert found[0]["match"].__class__ is list and len(found) == 2


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_exactly_one_ignores_repeated_keys_nobody_uses(spark, doubled, strategy):
    found = join(message_rows(spark, ["http://www.blogspot.com"] * 2), doubled, "exactly_one", strategy)
    assert [r["match"]["id"] for r in found.collect()] == [1, 1]


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("url, found", [(UNKNOWN, 0), (MEDIUM, 2)])
def test_exactly_one_fails(spark, doubled, strategy, url, found):
    joined = join(message_rows(spark, ["http://www.blogspot.com", url]), doubled, "exactly_one", strategy)
    # Whatever is asked for, a row count or a column of the event.
    for action in (joined.collect, joined.count, joined.select("url").collect):
        with pytest.raises(Exception, match=f"expected one match for key .*, got {found}"):
            action()


@pytest.mark.parametrize("strategy", ["auto", "merge"])
def test_a_match_that_comes_later_fails_too(spark, affiliate, tmp_path, strategy):
    """The table gets a second row between planning and running."""
    path = str(tmp_path / "dim")
    affiliate.write.saveAsTable("changing", path=path)
    try:
        joined = join(message_rows(spark, [MEDIUM]), spark.table("changing"), "exactly_one", strategy)
        assert joined.count() == 1
        affiliate.write.insertInto("changing")
        spark.catalog.refreshTable("changing")
        with pytest.raises(Exception, match="expected one match for key .*, got 2"):
            joined.select("url", "match").collect()
    finally:
        spark.sql("DROP TABLE changing")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_left_keeps_misses(spark, doubled, strategy):
    found = join(message_rows(spark, [MEDIUM, UNKNOWN]), doubled, "left", strategy).collect()
    assert sorted((r["url"], r["match"] and r["match"]["id"]) for r in found if r["url"] == MEDIUM) == [(MEDIUM, 2), (MEDIUM, 3)]
    assert [r["match"] for r in found if r["url"] == UNKNOWN] == [None]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_later_conditions_do_not_hide_a_miss(spark, affiliate, strategy):
    joined = join(message_rows(spark, [MEDIUM, UNKNOWN]), affiliate, "exactly_one", strategy)
    other = affiliate.select(F.col("id").alias("other"))
    for later in (
        joined.where("match.compensation > 0"),
        joined.where("match.id is not null").select("url"),
        joined.join(other, F.col("match.id") == F.col("other")).select("url"),
        joined.groupBy("match.id").count(),
    ):
        with pytest.raises(Exception, match="expected one match for key unknown.example, got 0"):
            later.collect()


def test_exactly_one_fails_for_a_null_key(spark):
    events = spark.createDataFrame([(None,)], "k int")
    dim = spark.createDataFrame([(None, "a"), (1, "b")], "id int, name string")
    for strategy in STRATEGIES:
        with pytest.raises(Exception, match="expected one match for key NULL, got 0"):
            lookup_join(events, dim, "k", "id", "exactly_one", strategy).collect()
        assert lookup_join(events, dim, "k", "id", "inner", strategy).collect() == []
        assert lookup_join(events, dim, "k", "id", "collect", strategy).first()["match"] == []


def test_null_value_is_left_out_of_the_message(spark, doubled):
    out = lookup_only(message_rows(spark, [MEDIUM]), doubled, "source_domain", columns=["id", "compensation"])
    assert sorted(r["value"] for r in out.collect()) == ['{"id":2,"compensation":0.01}', '{"id":3}']


def test_host_is_matched_verbatim(spark, affiliate):
    assert join(message_rows(spark, ["http://WWW.Medium.com"]), affiliate, "inner").collect() == []


def test_invalid_urls_fail_or_are_dropped(spark, affiliate):
    events = message_rows(spark, [MEDIUM, "not a url", None])
    for flow in (lookup_only, lookup_compose):
        with pytest.raises(Exception, match="invalid URL"):
            flow(events, affiliate, "source_domain").collect()
        assert flow(events, affiliate, "source_domain", on_invalid="drop").count() == 1


def test_added_fields_replace_columns_of_the_same_name(spark):
    dim = dim_rows(spark, [("www.medium.com", "theirs", 5)], "source_domain string, url string, timestamp int")
    out = lookup_compose(message_rows(spark, [MEDIUM]), dim, "source_domain")
    assert out.first()["value"] == (
        f'{{"source_domain":"www.medium.com","timestamp":9223371950454775,"url":"{MEDIUM}"}}'
    )


def test_an_event_without_a_time_fails_a_window(spark, affiliate):
    events = message_rows(spark, [MEDIUM])
    assert lookup_compose(events, affiliate, "source_domain").count() == 1
    with pytest.raises(Exception, match="event without a time"):
        lookup_compose(events, affiliate, "source_domain", window="5 minutes").collect()


def test_same_names_on_both_sides(spark):
    events = spark.createDataFrame([(1, "event")], "id int, name string")
    dim = spark.createDataFrame([(1, "table")], "id int, name string")
    row = lookup_join(events, dim, "id", "id").first()
    assert (row["name"], row["match"]["name"]) == ("event", "table")


def test_duplicate_columns_are_rejected(spark, affiliate):
    twice = affiliate.select("*", F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="duplicate column names: id"):
        join(message_rows(spark, [MEDIUM]), twice, "inner")


def test_odd_column_names(spark):
    events = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
    dim = spark.createDataFrame([(1, 9)], ["k.k", "v v"])
    assert lookup_join(events, dim, "a.b", "k.k").first()["match"]["v v"] == 9


def test_unknown_options(spark, affiliate):
    events = message_rows(spark, [MEDIUM])
    with pytest.raises(ValueError):
        join(events, affiliate, "some")
    with pytest.raises(ValueError):
        join(events, affiliate, "inner", "some")


def test_project_and_key_expressions(spark, affiliate):
    out = lookup_join(
        message_rows(spark, [MEDIUM]), affiliate, F.upper(url_host("url")), F.upper("source_domain"),
        project=[F.col("match.id").alias("n"), F.length("url").alias("l")],
    )
    assert out.collect() == [(2, len(MEDIUM))]


# How tables are joined


def test_a_table_is_broadcast_only_within_the_limit(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    events = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(1000).select("id", F.lit("x" * 100).alias("text"))
    assert fits(dim, 200 * 1000) and not fits(dim, 100 * 1000) and not fits(dim, 1000)
    assert fits(dim.drop("text"), 50 * 1000) and not fits(dim.drop("text"), 30 * 1000)
    for matches in ("inner", "exactly_one", "collect"):
        small = lookup_join(events, dim, "k", "id", matches, broadcast_limit=400 * 1000)
        large = lookup_join(events, dim, "k", "id", matches, broadcast_limit=50 * 1000)
        assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert Counter(map(str, small.collect())) == Counter(map(str, large.collect()))


@pytest.mark.parametrize("matches", ["inner", "left", "exactly_one", "collect"])
def test_a_hot_key_is_split(spark, settings, matches):
    """A third of the events has one key: the merge join splits that key's partition."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    events = spark.range(0, 120_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"),
        F.sha1(F.col("id").cast("string")).alias("text"),
    )
    dim = spark.range(2001).select(F.least("id", F.lit(1999)).alias("key"), F.col("id").alias("v"))
    joined = lookup_join(events, dim, "k", "key", matches, "merge")
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.count() == 120_000


@pytest.mark.parametrize("matches", ["inner", "exactly_one"])
def test_tables_bucketed_alike_are_not_shuffled(spark, settings, tmp_path, matches):
    """Grouping by the bucketing key takes no shuffle either."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    events = spark.range(1000).select("id", (F.col("id") % 100).alias("k"))
    dim = spark.range(100).select("id", F.lit("x").alias("text"))
    for df, name, key in ((events, "bucketed_events", "k"), (dim, "bucketed_dim", "id")):
        write_dim(df, "table", name, buckets=4, bucket_key=key, options={"path": str(tmp_path / name)})
    try:
        tables = [read_dim(spark, "table", n) for n in ("bucketed_events", "bucketed_dim")]
        joined = lookup_join(*tables, "k", "id", matches, "merge")
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert joined.count() == 1000
    finally:
        for name in ("bucketed_events", "bucketed_dim"):
            spark.sql(f"DROP TABLE {name}")


def test_a_stored_table_beyond_the_limit_is_not_measured(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(100_000).select("id", F.sha1(F.col("id").cast("string")).alias("text")).write.parquet(path)
    dim, jobs = spark.read.parquet(path), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("measuring", "")
    try:
        assert not fits(dim.where(F.col("id").isNotNull()), 1 << 20)
        assert not jobs.getJobIdsForGroup("measuring")
        assert fits(dim.where("id < 10"), 1 << 20)
        assert jobs.getJobIdsForGroup("measuring")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sizes_of_nested_and_null_values(spark):
    row = (["a" * 1000], {"k": "v" * 1000}, None)
    df = spark.createDataFrame([row], "a array<string>, m map<string,string>, s string")
    assert fits(df, 2500) and not fits(df, 2000)
    assert fits(df.limit(0), 0)


def test_columns_nobody_asks_for_are_not_read(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(10).select("id", F.lit("a").alias("used"), F.lit("b").alias("unused")).write.parquet(path)
    for matches in ("inner", "exactly_one"):
        joined = lookup_join(spark.range(3).toDF("k"), spark.read.parquet(path), "k", "id", matches)
        assert "unused" not in plan(joined.select("k", "match.used"))


def test_few_keys_are_sent_to_the_source(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    spark.range(1000).select("id", (F.col("id") * 2).alias("v")).write.parquet(path)
    dim = spark.read.parquet(path)
    keys = spark.createDataFrame([(3,), (5,)], "__lookup_key long")
    few = lookup._with_keys(dim, F.col("id"), keys, 1 << 20)
    assert "In(id, [3,5])" in plan(few)
    monkeypatch.setattr(lookup, "IN_LIST_LIMIT", 1)
    many = lookup._with_keys(dim, F.col("id"), keys, 1 << 20)
    assert "BroadcastHashJoin [id" in plan(many) and "LeftSemi" in plan(many)
    assert sorted(few.collect()) == sorted(many.collect()) == [(3, 6), (5, 10)]


def test_referenced_rows(spark):
    dim = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    events = spark.createDataFrame([(3,), (5,), (5,), (None,), (2000,)], "k long")
    assert sorted(referenced_rows(events, dim, "k", "id").collect()) == [(3, 6), (5, 10)]
    assert referenced_rows(events.where("k is null"), dim, "k", "id").collect() == []


def test_fetch_is_asked_once_per_distinct_key(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(keys: list) -> pd.DataFrame:
        import uuid

        (log / uuid.uuid4().hex).write_text("\n".join(map(str, keys)))
        return pd.DataFrame({"id": [k for k in keys if k % 2 == 0], "name": [f"n{k}" for k in keys if k % 2 == 0]})

    events = spark.range(1000).select((F.col("id") % 50).alias("k"))
    found = lookup_by_fetch(events, "k", fetch, "id long, name string", "id", batch_size=10, tasks=2)
    assert found.where(F.col("match.name") == F.concat(F.lit("n"), F.col("k"))).count() == 500
    found.count()
    asked = [f.read_text().split("\n") for f in log.iterdir()]
    assert sorted(int(k) for batch in asked for k in batch) == list(range(50))
    assert max(len(batch) for batch in asked) == 10


small_ints = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=12)


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=small_ints, table=small_ints)
def test_all_strategies_agree_with_brute_force(spark, events, table):
    left = spark.createDataFrame([(i, k) for i, k in enumerate(events)], "e int, k int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(table)], "key int, v int")
    expected = Counter((e, v) for e, k in enumerate(events) for v, t in enumerate(table) if k is not None and k == t)
    for strategy in STRATEGIES:
        inner = lookup_join(left, right, "k", "key", "inner", strategy).select("e", "match.v")
        assert Counter((r[0], r[1]) for r in inner.collect()) == expected
        for chunks, deal in ((1, None), (3, None), (2, F.col("v"))):
            lists = lookup_join(left, right, "k", "key", "collect", strategy, chunks=chunks, deal=deal).collect()
            assert Counter((r["e"], m["v"]) for r in lists for m in r["match"]) == expected
            assert {r["e"] for r in lists} == set(range(len(events)))
            assert max(Counter(r["e"] for r in lists).values(), default=0) <= chunks
            assert deal is None or all(m["v"] % 2 == r["chunk"] for r in lists for m in r["match"])
