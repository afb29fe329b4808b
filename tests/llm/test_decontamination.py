from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from streamlookup.llm import decontamination as dc
from streamlookup.llm.words import hashes_of, plain_words

from .conftest import SF_DIR


def plain_tiles(doc, item, least):
    """Greedy string tiling by its definition."""
    free_doc, free_item, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_doc[i + n] and free_item[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        i, j, n = best
        if n < least:
            return tiles
        tiles.append(best)
        free_doc[i : i + n] = [False] * n
        free_item[j : j + n] = [False] * n


@pytest.mark.parametrize("letters", [2, 4, 12])
def test_tiles(letters):
    rng = random.Random(letters)
    for _ in range(60):
        doc = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        item = [rng.randrange(letters) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.5:
            doc = doc[:10] + item[12:] + doc[10:20] + item[:12] + doc[20:]
        hashes = [np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (doc, item)]
        found, expected = dc.tile(*hashes, 3), plain_tiles(doc, item, 3)
        assert [n for *_, n in found] == [n for *_, n in expected]
        assert found == expected


def plain_matches(docs, items, least, coverage):
    found = set()
    for doc_id, text in docs:
        for item_id, item in items:
            words = plain_words(item)
            if not words:
                continue
            least = min(dc.LEAST_MATCH, len(words))
            ids = {w: i for i, w in enumerate(set(words))}
            runs = {tuple(words[i : i + least]) for i in range(len(words) - least + 1)}
            doc = plain_words(text)
            if not any(tuple(doc[i : i + least]) in runs for i in range(len(doc) - least + 1)):
                continue
            tiles = plain_tiles([ids.get(w, -1 - i) for i, w in enumerate(doc)], [ids[w] for w in words], least)
            covered = sum(n for *_, n in tiles)
            if covered >= coverage * len(words):
                found.add((doc_id, item_id, len(words), covered, len(tiles)))
    return found


def planted(sample):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    rng, docs = random.Random(8), [(r["doc_id"], r["text"]) for r in sample]
    for i, (item_id, text) in enumerate(items):
        words, other = text.split(), sample[i]["text"].split()
        half = len(words) // 2
        docs.append((1000 + i, " ".join([*other[:40], *words[half:], *other[40:60], *words[:half], *other[60:]])))
        docs.append((2000 + i, " ".join([*other[:40], *words[: half - 3], *other[40:]])))
        docs.append((3000 + i, text.upper().replace(" ", ",\n ")))
        rng.shuffle(words)
        docs.append((4000 + i, " ".join(words)))
    return docs, items


def test_documents(spark, sample):
    docs, items = planted(sample)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = plain_matches(docs, items, dc.LEAST_MATCH, dc.COVERAGE)
    ids = {d for d, *_ in expected}
    assert {1000 + i for i in range(len(items))} <= ids and {3000 + i for i in range(len(items))} <= ids
    assert not ids & {4000 + i for i in range(len(items))}
    for block_words in (dc.BLOCK_WORDS, 300):
        found = dc.benchmark_matches(*frames, block_words=block_words)
        assert {tuple(r)[:5] for r in found.collect()} == expected
        kept = dc.without_benchmark(*frames, block_words=block_words)
        assert sorted(map(tuple, kept.collect())) == sorted(d for d in docs if d[0] not in ids)


def test_odd_documents_and_items(spark, odd_docs):
    docs, rows = odd_docs
    items = [(1, "quick brown fox jumps over the lazy dog"), (1, "Quick brown fox jumps over the lazy dog"), (None, rows[0][1]),
             (2, None), (3, ""), (4, "one two"), (5, "the line ends here word after word goes")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = dc.benchmark_matches(docs, benchmark).collect()
    # The item of two words occurs whole in both of its documents.
    assert sorted((r.doc_id, r.item_id or 0) for r in found) == [(1, 0), (1, 0), (1, 1), (1, 1), (1, 1), (1, 1), (5, 5), (7, 4), (8, 4)]
    kept = dc.without_benchmark(docs, benchmark)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 2, 3, 4, 6, 9]


def test_scripts_without_blanks(spark):
    item = "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u54ea\u4e2a\u57ce\u5e02\uff0c\u5b83\u6709\u591a\u5c11\u4eba\u53e3\uff1f\u7b54\u6848\uff1a\u5317\u4eac\u3002"
    assert len(plain_words(item)) == 20 and plain_words("abc\u0e01\u0e34d1 \u30ab\u30ca") == ["abc", "\u0e01", "d1", "\u30ab", "\u30ca"]
    docs = [(1, item), (2, "before " + item[14:] + "x " + item[:14] + " after"), (3, item[::-1]), (4, item[:9])]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in dc.benchmark_matches(*frames).collect()) == [1, 2]
    assert sorted(r.doc_id for r in dc.without_benchmark(*frames).collect()) == [3, 4]


def test_short_items_match_whole(spark):
    docs = [(1, "He said: Open, Sesame! and went."), (2, "open the door, sesame"), (3, "xopen sesame"), (4, None)]
    items = [(1, "open sesame"), (2, "went"), (3, "."), (4, "one two three four five six")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = dc.benchmark_matches(*frames).collect()
    assert sorted((r.doc_id, r.item_id, r.n_tiles, r.coverage) for r in found) == [(1, 1, 1, 1.0), (1, 2, 1, 1.0)]


def test_nothing_to_match(spark, no_docs, odd_docs):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert dc.benchmark_matches(no_docs, no_items).collect() == []
    assert dc.benchmark_matches(odd_docs[0], no_items).collect() == []
    assert dc.without_benchmark(odd_docs[0], no_items).count() == len(odd_docs[1])
    assert dc.without_benchmark(no_docs, no_items).collect() == []


def test_long_common_text_is_one_tile():
    words = hashes_of([f"w{i}" for i in range(20_000)])
    assert dc.tile(words, words[5000:15_000], 5) == [(5000, 0, 10_000)]
