from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamlookup.llm import packing
from streamlookup.llm.word_ids import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def best_fit_decreasing(lengths, capacity):
    """Sequence by sequence, as it is defined."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            i = min(fitting, key=lambda i: rooms[i])
        else:
            rooms.append(capacity)
            i = len(rooms) - 1
        rooms[i] -= length
    return rooms


def filled(rows, capacity):
    """The sequences of a plan as lists of (offset, length); checks the slots' ranks."""
    ranks, sequences = defaultdict(list), defaultdict(list)
    for length, rank, count, first, offset in rows:
        ranks[length] += range(rank, rank + count)
        for i in range(count):
            sequences[first + i].append((offset, length))
    for length, found in ranks.items():
        assert sorted(found) == list(range(len(found)))
    return sequences, {length: len(found) for length, found in ranks.items()}


def gapless(parts, capacity):
    at = 0
    for offset, length in sorted(parts):
        assert offset == at
        at += length
    assert at <= capacity


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    sequences, counts = filled(packing.plan(Counter(lengths), 40), 40)
    assert counts == dict(Counter(lengths))
    for parts in sequences.values():
        gapless(parts, 40)
    rooms = best_fit_decreasing(lengths, 40)
    assert Counter(40 - sum(n for _, n in parts) for parts in sequences.values()) == Counter(rooms)


def test_plan_of_many_documents_is_small():
    rng = random.Random(3)
    histogram = {length: rng.randint(1, 10**6) for length in range(1, 4097)}
    rows = packing.plan(histogram)
    assert len(rows) < 200_000
    tokens = sum(length * n for length, n in histogram.items())
    sequences = max(first + count for _, _, count, first, _ in rows)
    assert sequences <= 1.01 * tokens / packing.CAPACITY


@pytest.mark.parametrize("length", [0, -1, 41])
def test_plan_rejects_what_fits_nowhere(length):
    with pytest.raises(ValueError, match="lengths"):
        packing.plan({length: 1}, 40)


def test_words_are_encoded_as_whole_texts(sample):
    texts = [r["text"] for r in sample] + [
        "", " \n ", "a<|endoftext|>b <|startoftext|> <|endoftext|>", "it's I'LL we'Ve 'd", "x\r\ny\x85z w",
        "İ ΣΑΣ ǅ ﬁ é é ́x", "foo_bar... a.b,c !!! 12,5 你好123abc", "y" * 500, "ÀÉß.ÿ!? ñ'", "ªº µ Å",
    ]
    library = Tokenizer.from_file(VOCABULARY)
    expected = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert WordEncoder(VOCABULARY).encode(texts) == expected


def test_forgotten_words_are_asked_again(monkeypatch, sample):
    encoder = WordEncoder(VOCABULARY)
    texts = [r["text"] for r in sample[:30]]
    expected = encoder.encode(texts)
    monkeypatch.setattr("streamlookup.llm.word_ids.CACHED_BYTES", 10_000)
    small = WordEncoder(VOCABULARY)
    assert [small.encode([t])[0] for t in texts] == expected and len(small.words) + len(small.words.old) < 100


def check_packed(rows, docs, capacity):
    """Every document's pieces, and every sequence without a gap."""
    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for i in range(0, len(ids), capacity):
            part = ids[i : i + capacity]
            expected[doc_id, i // capacity, i, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        gapless(parts, capacity)
    return sequences


def test_documents(spark, sample):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in sample], "doc_id long, text string").repartition(5)
    rows = packing.pack_documents(docs, VOCABULARY).collect()
    sequences = check_packed(rows, [(r["doc_id"], r["text"]) for r in sample], packing.CAPACITY)
    assert len(sequences) == len(best_fit_decreasing([r.length for r in rows], packing.CAPACITY))


def test_odd_documents(spark, odd_docs):
    docs, rows = odd_docs
    check_packed(packing.pack_documents(docs, VOCABULARY, capacity=64).collect(), rows, 64)


def test_no_documents(no_docs):
    packed = packing.pack_documents(no_docs, VOCABULARY)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.collect() == []


def test_one_length_in_many_blocks(spark):
    pieces = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, 5 + id % 9) AS length", "'old' AS offset", "id AS _rank")
    found = packing.pack(pieces.repartition(4), capacity=20, block_rows=10).collect()
    assert sorted(r.id for r in found) == list(range(1000)) and all(r._rank == r.id for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        gapless(parts, 20)
    assert len(sequences) == len(best_fit_decreasing([r.length for r in found], 20))


def test_pieces_without_length_get_no_place(spark):
    pieces = spark.createDataFrame([(1, 3), (2, None), (3, 0), (4, 3)], "id int, length int")
    found = {r.id: (r.sequence_id, r.offset) for r in packing.pack(pieces, capacity=6).collect()}
    assert found[2] == found[3] == (None, None)
    assert sorted([found[1], found[4]]) == [(0, 0), (0, 3)]
