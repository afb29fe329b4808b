"""Every registered query against its SQL."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from streamlookup.plans.batch_queries import BATCH_QUERIES
from streamlookup.plans.oracles import ORACLE_SQL
from streamlookup.plans.stream_queries import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = compare.spark_bag(QUERIES[name](spark, SF_DIR))
    assert got and got == compare.duck_bag(duck, ORACLE_SQL[name])
