"""From a bucket to the word itself, in the group that the window belongs to.

Each word is counted over the whole corpus in each group of windows. Its chance in its
bucket is its share of the bucket's count in the window's group, next to which its share in
all groups counts a little. Those of a bucket's words add up to one in every group.

The words' counts are a table that grows with the corpus. It is made and joined in
shards of hashes, and no task or worker holds all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from streamlookup.llm.lm_scoring import GROUPS, Chunk, Model, batch_of, chunks, packed, rows_of, unpacked

# Occurrences that the share in all groups counts as.
PLAIN_COUNT = 4.0

# Pairs of word and chunk in a shard, about, and the fewest and most shards; a bucket is in one.
SHARD_PAIRS = 1 << 20
SHARDS = (16, 1 << 16)

_ASKED = "shard int, chunk long, hashes binary, counts binary"
_KNOWN = "chunk long, {}doc_ids array<long>, sizes binary, words binary, buckets binary, counts binary, n_words long"
_GIVEN, _PLACES = _KNOWN.format("shard int, "), _KNOWN.format("")


def shares_in(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The log of each word's chance in its bucket, by group, from the word's counts by group
    and those of its whole bucket."""
    plain = counts.sum(axis=1, keepdims=True) / whole.sum(axis=1, keepdims=True)
    return np.log((counts + PLAIN_COUNT * plain) / (whole + PLAIN_COUNT))


def with_words(
    encoded: DataFrame,
    model: Model,
    use: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter,
    schema: str = _PLACES,
) -> DataFrame:
    """The rows of ``encoded`` with their words' counts in the whole corpus by group (``counts``),
    and buckets instead of hashes; or what ``use`` makes of them, of ``schema``.

    ``use`` runs in the worker that puts the rows together: a step of its own would give each task a
    second one. ``n_words`` adds up to the size of the vocabulary over all rows.
    """
    arrows = {x: to_arrow_schema(_parse_datatype_string(x)) for x in (_ASKED, _GIVEN, _PLACES)}
    pairs = encoded.agg(F.sum(F.octet_length("hashes"))).collect()[0][0] or 0
    n = max(SHARDS[0], min(SHARDS[1], 1 << (pairs // 8 // SHARD_PAIRS).bit_length()))
    bits = n.bit_length() - 1
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            key = chunk.words.astype(np.int64) * GROUPS + shared.value.groups(chunk)
            counts = np.bincount(key, minlength=len(chunk.hashes) * GROUPS).astype(np.uint32).reshape(-1, GROUPS)
            ends = np.searchsorted(chunk.hashes >> np.uint64(64 - bits), np.arange(n + 1).astype(np.uint64))
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                if b > a:
                    yield batch_of([(i, chunk.id, chunk.hashes[a:b].tobytes(), packed(counts[a:b]))], arrows[_ASKED])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, group in groupby(rows_of(batches), key=lambda row: row[0]):
            ids, hashes, counts = [], [], []
            for _, chunk, h, c in group:
                ids.append(chunk)
                hashes.append(np.frombuffer(h, np.uint64))
                counts.append(c)
            known, index = np.unique(np.concatenate(hashes), return_inverse=True)
            parts = np.split(index, np.cumsum([len(h) for h in hashes])[:-1])
            total = np.zeros((len(known), GROUPS), np.int64)
            for part, c in zip(parts, counts):
                total[part] += unpacked(c, np.uint32).reshape(-1, GROUPS)  # distinct within a chunk
            for i, part in enumerate(parts):
                yield batch_of([(ids[i], shard, None, None, None, None, packed(total[part]), 0 if i else len(known))], arrows[_GIVEN])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            row = chunk.row
            yield batch_of([(chunk.id, -1, row["doc_ids"], row["sizes"], row["words"], packed(chunk.buckets), None, 0)], arrows[_GIVEN])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, group in groupby(rows_of(batches), key=lambda row: row[0]):
            first, *others = group  # the row itself, then what its shards answer
            found = np.concatenate([unpacked(row[6], np.int64) for row in others] or [np.empty(0, np.int64)])
            yield batch_of([(chunk, *first[2:6], packed(found), sum(row[7] for row in others))], arrows[_PLACES])

    requests = encoded.select("chunk", "sizes", "words", "hashes").mapInArrow(ask, _ASKED)
    answers = requests.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(answer, _GIVEN)
    rows = encoded.mapInArrow(own, _GIVEN).union(answers).repartition("chunk").sortWithinPartitions("chunk", "shard")
    return rows.mapInArrow(lambda batches: use(gather(batches)), schema)


def word_log_probs(model: Model, chunk: Chunk) -> np.ndarray:
    """Log-probability of each word in its bucket, given its window."""
    counts = unpacked(chunk.row["counts"], np.int64).reshape(-1, GROUPS)
    return shares_in(counts, model.met[chunk.buckets])[chunk.words, model.groups(chunk)]
