from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import streamlookup.operators.skew as skew
from streamlookup.operators.grouping import cogroup, cogroup_aggregate, group_values
from streamlookup.operators.latest import latest_per_key


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_has_one_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "c")], "k int, v string")
    found = group_values(df, ["k"])
    assert found.columns == ["k", "chunk", "values"]
    assert {r["k"]: sorted(v["v"] for v in r["values"]) for r in found.collect()} == {1: ["a", "a", "b"], None: ["c"]}


@pytest.mark.parametrize("chunks", [1, 8])
def test_the_answer_does_not_depend_on_size(spark, chunks):
    """A NULL key and a key whose rows are all alike, of 25,000 rows each."""
    third = F.col("id") % 3
    df = spark.range(0, 75_000, 1, 16).select(
        F.when(third == 0, None).when(third == 1, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(third == 1, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )
    rows = group_values(df, ["k"], chunks=chunks).select("k", "chunk", F.size("values").alias("n")).collect()
    assert len({(r["k"], r["chunk"]) for r in rows}) == len(rows)
    for key, most in ((None, 1.2), (-1, 4)):  # copies are spread by the partitions they come from
        parts = [r["n"] for r in rows if r["k"] == key]
        assert sum(parts) == 25_000 and len(parts) <= chunks
        assert max(parts) <= most * 25_000 / chunks
    assert sum(r["n"] for r in rows) == 75_000


def test_chunks_are_dealt_as_asked(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    for r in group_values(df, ["k"], chunks=5, deal=F.col("v")).collect():
        assert {v["v"] % 5 for v in r["values"]} == {r["chunk"]} and len(r["values"]) == 10
    with pytest.raises(ValueError, match="chunks"):
        skew.with_chunk(df, 0)


@pytest.mark.parametrize("chunks", [1, 4])
def test_rows_are_read_and_shuffled_once(spark, tmp_path, chunks):
    path = str(tmp_path / "rows")
    spark.range(100).select((F.col("id") % 3).alias("k"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    for found, sides in ((group_values(df, ["k"], chunks=chunks), 1), (cogroup(df, df, ["k"], chunks=chunks), 2)):
        assert plan(found).count("Exchange") == 1 and plan(found).count("FileScan") == sides


def test_chunks_do_not_depend_on_the_order_of_rows(spark):
    """A task that is repeated may read its shuffled rows in another order."""
    df = spark.range(0, 3_000, 1, 1).select(F.lit(1).alias("k"), (F.col("id") % 700).alias("v"))
    first, again = (
        Counter(map(tuple, skew.with_chunk(df.sortWithinPartitions(order), 100).collect()))
        for order in (F.col("v"), F.hash("v"))
    )
    assert first == again and len(first) > 100


def test_maps_can_be_dealt(spark):
    df = spark.range(0, 5_000, 1, 4).select(F.lit("k").alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    rows = group_values(df, ["k"], chunks=10).select(F.size("values").alias("n")).collect()
    assert sum(r["n"] for r in rows) == 5_000 and max(r["n"] for r in rows) < 1_000


def test_cogroup_keeps_keys_of_either_side(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (3, 30), (None, 0)], "k int, r int")
    rows = cogroup(left, right, ["k"]).collect()
    got = {r["k"]: (sorted(v["l"] for v in r["left"]), [v["r"] for v in r["right"]]) for r in rows}
    assert got == {1: (["a", "b"], [10]), 2: (["c"], []), 3: ([], [30]), None: (["n"], [0])}


def test_cogroup_keeps_null_values_and_splits(spark):
    left = spark.range(100).select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("l"))
    right = spark.range(5).select(F.lit(1).alias("k"), F.col("id").alias("r"))
    rows = cogroup(left, right, ["k"], chunks=5, deal=F.coalesce("right.r", F.monotonically_increasing_id())).collect()
    assert len(rows) == 5
    assert sum(len(r["left"]) for r in rows) == 100
    assert sorted(v["r"] for r in rows for v in r["right"]) == [0, 1, 2, 3, 4]


def test_cogroup_of_same_names_and_of_keys_only(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    rows = cogroup(left, left.withColumn("v", F.upper("v")), ["k"]).collect()
    assert (rows[0]["left"][0]["v"], rows[0]["right"][0]["v"]) == ("a", "A")
    keys, counts = left.select("k"), [F.count("left").alias("l"), F.count("right").alias("r")]
    assert cogroup_aggregate(keys, keys, ["k"], counts).collect() == [(1, 1, 1)]


def test_latest_per_key(spark):
    rows = [(1, 5, 1, "a"), (1, 7, 2, "b"), (1, 7, 3, "c"), (2, 1, 4, None), (None, 1, 5, "n"), (None, 0, 6, "o")]
    df = spark.createDataFrame(rows, "k int, t int, id int, v string")
    latest = latest_per_key(df, ["k"], "t", ["id"])
    assert latest.columns == df.columns
    assert set(map(tuple, latest.collect())) == {(1, 7, 3, "c"), (2, 1, 4, None), (None, 1, 5, "n")}


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 2))), max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keyed, right=keyed, chunks=st.sampled_from([1, 3]))
def test_cogroup_agrees_with_brute_force(spark, left, right, chunks):
    a, b = (spark.createDataFrame(rows, "k int, v int") for rows in (left, right))
    rows = cogroup(a, b, ["k"], chunks=chunks).collect()
    for name, source in (("left", left), ("right", right)):
        assert Counter((r["k"], x["v"]) for r in rows for x in r[name]) == Counter(source)
    assert {r["k"] for r in rows} == {k for k, _ in left + right}
    counts = cogroup_aggregate(a, b, ["k"], [F.count("left").alias("l"), F.count("right").alias("r")]).collect()
    expected = {(k, sum(x == k for x, _ in left), sum(x == k for x, _ in right)) for k, _ in left + right}
    assert {tuple(r) for r in counts} == expected
