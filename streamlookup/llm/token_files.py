"""Token ids in files of compressed documents that share a zstandard dictionary.

A shard file is: the magic, the dictionary's hash (8 bytes), the bytes per id
(4 bytes), a zstandard frame per document, then the index - an array of frame
offsets (one more than documents), of document ids, of flags that tell a NULL
document id, and of token counts - and at the end the index's offset and the
number of documents (8 bytes each). All numbers are little-endian. A document is
read by its index entry alone, and a file only with the dictionary it names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from streamlookup.llm.sampling import is_among, place_of
from streamlookup.llm.word_ids import id_bytes, word_encoder
from streamlookup.sources.shared import open_folder, work_folder, written

MAGIC = b"TOKENZ1\n"
_HEAD = struct.Struct("<8sQI")
_TAIL = struct.Struct("<QQ")

# Documents in a file. Bounds its index, and what a reader of one file does.
SHARD_DOCS = 8192

# The dictionary is trained on a bounded sample: short documents, for which a
# dictionary matters, chosen by the hash of their text.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 4_000
DICTIONARY_BYTES = 64 * 1024

LEVEL = 3
SLICE = 256

MANIFEST = "shard int, path string, first_id long, last_id long, n_docs long, n_tokens long"
ENTRIES = "doc_id long, start long, n_tokens long, ids_crc32 long"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for serialized id arrays. With too few samples to
    train one, their bytes serve as they are; without any it is empty."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def dictionary_hash(dictionary: bytes) -> int:
    return xxhash.xxh3_64_intdigest(dictionary)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


class ShardWriter:
    """Writes documents one after the other; holds only the index."""

    def __init__(self, stream, dictionary: bytes, id_width: int):
        self.stream, self.width = stream, id_width
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        self.at = stream.write(_HEAD.pack(MAGIC, dictionary_hash(dictionary), id_width)) and _HEAD.size
        self.offsets, self.doc_ids, self.counts = [self.at], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.width == 2 and len(ids) and ids.max() > 0xFFFF:
            raise ValueError(f"id {ids.max()} does not fit in 2 bytes")
        frame = self.compressor.compress(ids.astype(f"<u{self.width}").tobytes())
        self.stream.write(frame)
        self.at += len(frame)
        self.offsets.append(self.at)
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))

    def close(self) -> None:
        self.stream.write(np.array(self.offsets, "<u8").tobytes())
        self.stream.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.stream.write(np.array([d is None for d in self.doc_ids], "u1").tobytes())
        self.stream.write(np.array(self.counts, "<u8").tobytes())
        self.stream.write(_TAIL.pack(self.at, len(self.counts)))


class ShardReader:
    """Reads single documents of a shard file by their place in its index."""

    def __init__(self, stream, dictionary: bytes):
        self.stream = stream
        magic, found, self.width = _HEAD.unpack(self._bytes(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        if found != dictionary_hash(dictionary):
            raise ValueError("the file was written with another dictionary")
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        end = stream.size() - _TAIL.size
        index, n = _TAIL.unpack(self._bytes(end, _TAIL.size))
        data = self._bytes(index, end - index)
        ends = np.cumsum([8 * (n + 1), 8 * n, n])
        self.offsets = np.frombuffer(data[: ends[0]], "<u8")
        doc_ids = np.frombuffer(data[ends[0] : ends[1]], "<i8").tolist()
        null = np.frombuffer(data[ends[1] : ends[2]], "u1")
        self.doc_ids = [None if gone else d for d, gone in zip(doc_ids, null)]
        self.counts = np.frombuffer(data[ends[2] :], "<u8")

    def _bytes(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> np.ndarray:
        frame = self._bytes(int(self.offsets[i]), int(self.offsets[i + 1] - self.offsets[i]))
        size = int(self.counts[i]) * self.width
        ids = np.frombuffer(self.decompressor.decompress(frame, max_output_size=size), f"<u{self.width}")
        if len(ids) != self.counts[i]:
            raise ValueError(f"document {i} has {len(ids)} ids, its index says {self.counts[i]}")
        return ids.astype("<u4")


@lru_cache(maxsize=2)
def _read_file(folder: str, name: str) -> bytes:
    files, path = open_folder(folder)
    with files.open_input_file(f"{path}/{name}") as stream:
        return stream.read()


def sample_dictionary(docs: DataFrame, tokenizer: str, end_id: int, id_width: int) -> bytes:
    """Train on at most ``SAMPLE_DOCS`` short texts, the same ones however the table
    is partitioned."""
    place = place_of("doc_id", "text")
    texts = docs.where(F.length("text") <= SAMPLE_CHARS).where(is_among(place, SAMPLE_DOCS, docs.count()))
    rows = texts.orderBy(place, "text").select("text").limit(SAMPLE_DOCS).collect()
    found = word_encoder(tokenizer).encode([r["text"] for r in rows])
    return train_dictionary(
        [np.frombuffer(ids + id_bytes([end_id]), "<u4").astype(f"<u{id_width}").tobytes() for ids in found]
    )


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_width: int = 2, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """Write the token ids of whole texts, ascending by ``doc_id``, as shard files.

    Returns the manifest: a row per file. A NULL text is empty, and has the end
    id only; a NULL ``doc_id`` comes first; rows with the same one all stay, ordered
    by the hash of their text. An empty table gives no file and an empty manifest.
    Only ``doc_id`` and ``text`` are used, whatever other columns there are.

    Texts are shuffled once, by ranges of ``doc_id``, and tokenised while they are
    written. A task that is run again writes a file of another name; the manifest
    names the files of the runs that counted.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    dictionary = sample_dictionary(docs, tokenizer, end_id, id_width)
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/dictionary") as stream:
        stream.write(dictionary)
    end = id_bytes([end_id])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        files, path = open_folder(folder)
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = ShardWriter(files.open_output_stream(f"{path}/{name}"), _read_file(folder, "dictionary"), id_width)
            for at in range(0, batch.num_rows, SLICE):
                doc_ids, texts = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                for doc_id, ids in zip(doc_ids, word_encoder(tokenizer).encode(texts)):
                    writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if writer is not None:
            writer.close()
            writer.stream.close()
            ids = writer.doc_ids
            row = (TaskContext.get().partitionId(), name, ids[0], ids[-1], len(ids), sum(writer.counts))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, manifest)], schema=manifest)

    manifest = to_arrow_schema(_parse_datatype_string(MANIFEST))
    shards = max(1, -(-docs.count() // shard_docs))
    tie = F.xxhash64("text")
    ordered = docs.repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    return written(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Read shard files back: a row per document, with ``start`` counted over the
    files in their order, and the crc of its ids as unsigned 32-bit integers."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    entries = to_arrow_schema(_parse_datatype_string(ENTRIES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder_path = open_folder(folder)
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(f"{folder_path}/{path}") as stream:
                    reader = ShardReader(stream, _read_file(folder, "dictionary"))
                    crc = [zlib.crc32(reader.ids(i)) for i in range(len(reader))]
                counts = reader.counts.astype(np.int64)
                columns = [reader.doc_ids, base + np.cumsum(counts) - counts, counts, crc]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, entries)], schema=entries)

    # One file to a task: ranges of the shard number spread them evenly.
    shards = max(1, manifest.count())
    return files.repartitionByRange(shards, "shard").select("path", "base").mapInArrow(read, ENTRIES)


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the documents below the shared work folder and read them back."""
    folder = work_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)


def read_document(manifest: DataFrame, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document's rows, from the files that can hold it, without
    reading other documents."""
    known = (F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id)
    found = []
    for row in manifest.where(known).collect():
        files, path = open_folder(folder)
        with files.open_input_file(f"{path}/{row['path']}") as stream:
            reader = ShardReader(stream, _read_file(folder, "dictionary"))
            found += [reader.ids(i) for i, d in enumerate(reader.doc_ids) if d == doc_id]
    return found
