from __future__ import annotations

import io
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from streamlookup.llm import token_counts, token_files
from streamlookup.sources.shared import work_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return token_counts.PieceModel(PIECES)


def test_counts_are_the_librarys(model, library, sample):
    rng = random.Random(5)
    letters = "abcdefghij -=_.#*/ \n▁éab  "
    texts = [r["text"] for r in sample]
    texts += ["", " ", "<s> </s> <unk> <0x0A>", "日本語 😀\x00", "-" * 100, " " * 77 + "x" + " " * 40, "▁▁ ▁x▁", "\n\n  \t\r\n é"]
    texts += ["a" * 500, "ab" * 3000, "=" * 37 + "-" * 21]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(500)]
    texts += ["".join(rng.choice("theinreosand=-") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    assert model.count(texts) == [len(ids) for ids in library.encode(texts)]
    assert model.count([None]) == [0]


def test_a_long_text_without_blanks(model, library):
    text = "".join(random.Random(1).choices("theinreosand", k=60_000))
    assert model.count([text]) == [len(library.encode(text))]


def test_forgotten_pretokens_are_counted_again(monkeypatch, model, library, sample):
    texts = [r["text"] for r in sample[:20]]
    monkeypatch.setattr(token_counts, "CACHED_PRETOKENS", 10)
    assert [model.count([t])[0] for t in texts] == [len(ids) for ids in library.encode(texts)]


def test_count_odd_documents(odd_docs, library):
    docs, rows = odd_docs
    found = token_counts.count_tokens(docs, PIECES, limit=100).collect()
    expected = Counter()
    for doc_id, text in rows:
        n = len(library.encode(text or ""))
        expected[doc_id, len((text or "").encode()), n, n > 100] += 1
    assert Counter(map(tuple, found)) == expected


def test_count_no_documents(no_docs):
    assert token_counts.count_tokens(no_docs, PIECES).collect() == []


def expected_entries(rows):
    """By doc_id, NULL first, then by anything; start counts what is before."""
    library = Tokenizer.from_file(WORDS)
    return [
        (doc_id, np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")) for doc_id, text in rows
    ]


def check_entries(found, rows):
    expected = Counter((doc_id, len(ids), zlib.crc32(ids.tobytes())) for doc_id, ids in expected_entries(rows))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))


def test_round_trip(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    docs = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), "doc_id long, text string")
    folder = work_folder(spark, "files")
    manifest = token_files.write_token_files(docs, folder, WORDS, shard_docs=30)
    assert manifest.count() > 3
    check_entries(token_files.read_token_files(manifest, folder).collect(), rows)
    doc_id, ids = expected_entries(rows[77:78])[0]
    (read,) = token_files.read_document(manifest, folder, doc_id)
    assert read.tolist() == ids.tolist()


def test_round_trip_of_odd_documents(odd_docs):
    docs, rows = odd_docs
    check_entries(token_files.token_round_trip(docs, WORDS).collect(), rows)


def test_round_trip_of_no_documents(no_docs):
    assert token_files.token_round_trip(no_docs, WORDS).collect() == []


@pytest.mark.parametrize("dictionary", [b"", b"some bytes that are no dictionary" * 20])
def test_a_file_needs_its_dictionary(dictionary):
    class Stream(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    stream = Stream()
    writer = token_files.ShardWriter(stream, dictionary, 2)
    documents = [np.arange(n, dtype="<u4") for n in (0, 1, 300, 65_000)]
    for i, ids in enumerate(documents):
        writer.add(None if i == 1 else i, ids)
    with pytest.raises(ValueError, match="does not fit"):
        writer.add(9, np.array([70_000], "<u4"))
    writer.close()
    reader = token_files.ShardReader(stream, dictionary)
    assert reader.doc_ids == [0, None, 2, 3]
    assert all(reader.ids(i).tolist() == ids.tolist() for i, ids in enumerate(documents))
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.ShardReader(stream, b"another")


def test_a_dictionary_makes_short_documents_smaller(sample):
    ids = [e[1].astype("<u2").tobytes() for e in expected_entries([(0, r["text"]) for r in sample if r["n_chars"] < 2000])]
    dictionary = token_files.train_dictionary(ids[::2] * 20, 16_384)

    def size(data):
        stream = io.BytesIO()
        writer = token_files.ShardWriter(stream, data, 2)
        for i, part in enumerate(ids[1::2]):
            writer.add(i, np.frombuffer(part, "<u2"))
        return writer.at

    assert size(dictionary) < 0.97 * size(b"")
