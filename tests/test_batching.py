"""Batches and lists of bounded size, and Bloom filters."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlookup.operators.batching import chunks_for, cogroup_bounded, group_values_bounded, key_batches, rank_in_key
from streamlookup.operators.bloom import bloom_filter, prune
from streamlookup.operators.lookup import lookup_join, rows_with_keys
from streamlookup.sources.shared import written


def hot_rows(spark, n=30_000):
    """A third of all rows has one key."""
    return spark.range(n, numPartitions=6).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 500)) AS k", "id AS v")


@pytest.mark.parametrize("block_rows", [700, 1_000_000])
def test_ranks_are_gapless(spark, block_rows):
    ranks = defaultdict(list)
    for r in rank_in_key(hot_rows(spark), ["k"], block_rows=block_rows).collect():
        ranks[r["k"]].append(r["rank"])
    assert len(ranks["hot"]) == 10_000
    assert all(sorted(found) == list(range(len(found))) for found in ranks.values())


def test_a_hot_key_is_ranked_by_many_tasks(spark, settings):
    settings(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false",
             spark__sql__adaptive__skewJoin__enabled="false")
    one_key = spark.range(16_000, numPartitions=4).selectExpr("'hot' AS k", "id AS v")
    ranked = rank_in_key(one_key, ["k"], block_rows=500)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    # Rows are dealt by key, file and block; only the counts per block by key alone.
    assert sum("_file" in keys and "_block" in keys for keys in shuffles) >= 1
    sizes = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 16_000 / 2


def test_batches_are_full_but_the_last(spark):
    batched = key_batches(hot_rows(spark), ["k"], 500).collect()
    assert sorted(r["v"] for r in batched) == list(range(30_000))
    sizes = Counter((r["k"], r["batch"]) for r in batched)
    totals = Counter(r["k"] for r in batched)
    for key, total in totals.items():
        batches = -(-total // 500)
        assert [sizes[key, b] for b in range(batches)] == [min(500, total - 500 * b) for b in range(batches)]
    assert len(sizes) == sum(-(-n // 500) for n in totals.values())


def test_odd_keys_and_names(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 1.0), (float("nan"), 2.0), (1.0, 3.0)], "`a b` double, _file double")
    found = key_batches(rows, ["a b"], 1, "_row").collect()
    assert sorted(r["_row"] for r in found) == [0, 0, 0, 1]
    assert key_batches(rows.where("false"), ["a b"]).collect() == []
    with pytest.raises(ValueError, match="at least"):
        key_batches(rows, ["a b"], 0)
    with pytest.raises(ValueError):
        key_batches(rows, ["a b"], 1, "_file")


def test_no_list_is_above_its_bound(spark):
    lists = group_values_bounded(hot_rows(spark), ["k"], size=64).collect()
    assert max(len(r["values"]) for r in lists) == 64
    assert sorted(v["v"] for r in lists for v in r["values"]) == list(range(30_000))
    assert Counter(r["k"] for r in lists)["hot"] == -(-10_000 // 64)


keyed = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=12)


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keyed, right=keyed, size=st.sampled_from([1, 3, 100]))
def test_cogroup_agrees_with_brute_force(spark, left, right, size):
    a, b = (spark.createDataFrame(rows, "k string, v int") for rows in (left, right))
    rows = cogroup_bounded(a, b, ["k"], size=size).collect()
    for name, want in (("left", left), ("right", right)):
        assert Counter((r["k"], v["v"]) for r in rows for v in r[name]) == Counter(want)
    assert all(1 <= len(r["left"]) + len(r["right"]) <= size for r in rows)
    assert len({(r["k"], r["chunk"]) for r in rows}) == len(rows)


def test_chunks_for_the_largest_group(spark):
    assert chunks_for(hot_rows(spark), ["k"], 1_000) == 10
    assert chunks_for(hot_rows(spark).where("false"), ["k"], 1_000) == 1


@pytest.mark.parametrize("strategy", ["auto", "merge"])
def test_bounded_lists_of_matches(spark, strategy):
    dim = hot_rows(spark, 3_000)
    events = spark.createDataFrame([(1, "hot"), (2, "k1"), (3, "none"), (4, None), (5, "hot")], "e int, key string")
    rows = lookup_join(events, dim, "key", "k", "collect", strategy, list_size=100).collect()
    found = defaultdict(list)
    for r in rows:
        assert len(r["match"]) <= 100
        found[r["e"]] += [m["v"] for m in r["match"]]
    want = defaultdict(list)
    for r in dim.collect():
        want[r["k"]].append(r["v"])
    assert {e: sorted(v) for e, v in found.items()} == {1: want["hot"], 2: want["k1"], 3: [], 4: [], 5: want["hot"]}
    with pytest.raises(ValueError, match="either"):
        lookup_join(events, dim, "key", "k", "collect", chunks=2, list_size=3)


def test_bloom_filter_loses_nothing_and_prunes(spark):
    keys = spark.range(0, 200_000, 10).withColumnRenamed("id", "key")
    bloom = bloom_filter(keys, F.col("key"), keys.count())
    table = spark.range(200_000).selectExpr("if(id % 1000 = 999, null, id) AS id", "id AS row")
    pruned = prune(table, F.col("id"), bloom)
    assert pruned.columns == table.columns
    found = {r["id"] for r in pruned.collect()}
    assert found >= set(range(0, 200_000, 10)) and None not in found
    assert len(found) - 20_000 < 0.03 * 180_000
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("limit", [64 << 20, 12 * 4096, 4096])
def test_rows_with_very_many_keys(spark, limit):
    """With less room there are fewer bits per key, in the end no filter; the rows are the same."""
    keys = written(spark.range(0, 100_000, 5).selectExpr("concat('k', id) AS key"), "keys")
    table = spark.range(100_000).selectExpr("concat('k', id) AS k", "id")
    found = rows_with_keys(table, F.col("k"), keys, F.col("key"), limit)
    assert sorted(r["id"] for r in found.collect()) == list(range(0, 100_000, 5))
    assert ("getbit" in found._jdf.queryExecution().optimizedPlan().toString()) is (limit > 4096)


def test_no_keys(spark):
    keys = written(spark.range(0).withColumnRenamed("id", "key"), "keys")
    assert rows_with_keys(spark.range(10), F.col("id"), keys, F.col("key")).collect() == []
