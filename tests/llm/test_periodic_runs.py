"""Runs against their definition, and the query against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from streamlookup.llm.periodic_runs import (
    DIRECT_PERIODS,
    collapsed,
    periodic_runs,
    repeat_tail,
    run_digests,
    runs_of,
    seeds,
    strongest,
)
from streamlookup.llm.queries import op13_periodic_runs


def by_definition(words):
    """Every maximal stretch, period by period, word by word."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            least = all(part[p:] != part[:-p] for p in range(1, q))
            if length >= max(24, 3 * q) and least:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_text(rng, letters, parts):
    words = []
    for _ in range(parts):
        part = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 90))]
        words += part if rng.random() < 0.4 else (part * 8)[: int(len(part) * rng.uniform(1.5, 6))]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_runs_equal_the_definition(letters):
    rng = random.Random(letters)
    for _ in range(40):
        texts = [made_text(rng, letters, rng.randint(0, 5)) for _ in range(rng.randint(1, 5))]
        assert runs_of(texts) == [by_definition(words) for words in texts]


@pytest.mark.parametrize("period", [1, 8, 9, 16, 17, 24, 25, 36, 37, 101, 333])
@pytest.mark.parametrize("times", [3, 4.5])
def test_every_period_is_found(period, times):
    unit = [b"u%d" % i for i in range(period)]
    length = max(24, int(period * times))
    run = (unit * 30)[:length]
    words = [b"before"] * 2 + [b"x"] + run + [b"y", b"after"]
    found = runs_of([[], words, [b"other"] * 5])
    assert found[1] == [(3, length, period)] and found[0] == found[2] == []


def test_a_run_one_word_short_is_none():
    unit = [b"u%d" % i for i in range(50)]
    assert runs_of([(unit * 3)[:-1]]) == [[]]
    assert runs_of([[b"a"] * 23]) == [[]] and runs_of([[b"a"] * 24]) == [[(0, 24, 1)]]


def test_runs_of_long_periods_come_from_seeds():
    import numpy as np

    codes = np.tile(np.arange(100), 4)
    low = DIRECT_PERIODS
    while 3 * low // 2 < 100:
        assert not len(seeds(codes, low)[0])  # no scale below proposes anything
        low = 3 * low // 2
    places, periods, high = seeds(codes, low)
    assert low < 100 <= high and len(places) and set(periods.tolist()) == {100}


def test_neighbouring_texts_do_not_make_runs():
    assert runs_of([[b"a"] * 20, [b"a"] * 20]) == [[], []]


def test_strongest_and_collapsed():
    runs = [(0, 30, 10), (40, 24, 8), (50, 48, 16)]
    assert strongest(runs) == (0, 30, 10) and strongest([]) is None
    assert strongest([(5, 25, 5), (0, 30, 6)]) == (0, 30, 6)
    words = [b"%d" % i for i in range(3)] * 10 + [b"end"]
    assert collapsed(words, runs_of([words])[0]) == [b"0", b"1", b"2", b"end"]


def expected_row(doc_id, text):
    words = repeat_tail(doc_id, (text or "").encode().split())
    runs = by_definition(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    stays = [not any(s + q <= i < s + n for s, n, q in runs) for i in range(len(words))]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    rest = b" ".join(w for w, stay in zip(words, stays) if stay)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()
    return (doc_id, len(runs), *best, milli, *digests)


def test_repeat_tail():
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0]
    words = [b"w%d" % i for i in range(200)]
    changed = [i for i in range(1000) if repeat_tail(i, words) != words]
    assert set(changed) <= set(ids) and len(changed) > 0.9 * len(ids)
    assert all(len(repeat_tail(i, words)) == 200 for i in ids)
    assert repeat_tail(None, words) == words and repeat_tail(ids[0], []) == []


def test_query_equals_plain_python(spark, sample):
    short = [r for r in sample if len((r["text"] or "").split()) < 1500]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in short], schema)
    got = run_digests(periodic_runs(docs, prepare=repeat_tail)).collect()
    assert sorted(map(tuple, got)) == sorted(expected_row(r["doc_id"], r["text"]) for r in short)
    assert any(r["n_runs"] for r in got)


def test_whole_table(spark, sample):
    rows = op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in sample)


def test_odd_documents(spark, odd_docs, no_docs):
    frame, rows = odd_docs
    got = periodic_runs(frame).collect()
    assert len(got) == len(rows)
    by_text = {r["collapsed"]: r for r in got}
    assert by_text[""]["n_runs"] == 0 and by_text[""]["start"] is None
    long_row = next(r for r in got if r["doc_id"] == 5)
    assert (long_row["start"], long_row["period"], long_row["length"]) == (0, 12, 36_000)
    assert long_row["collapsed"] == "Word after word goes on and on until the line ends here."
    assert periodic_runs(no_docs).collect() == []
