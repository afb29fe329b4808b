"""Masked pseudo-likelihood of documents.

A network predicts a word from the words in a window on both sides of it. A document's
score is the sum of the log-probabilities of all its words, each given its window.

Words are known by 65,536 hashed buckets and, in a table that grows with the corpus, one
by one (`streamlookup.llm.lm_words`). How often each bucket has each of the most frequent
ones near it is counted over the whole corpus, and gives every bucket a vector. From the
vectors of the window the network works out weights of a few experts, each of which is a
distribution over all buckets: the chance of a bucket is the weighted mean of theirs.
The word's chance in its bucket hangs on the window as well.

The network and the experts are trained over all documents in rounds, in which every
word is masked once. What is trained together is a chunk of documents, dealt by a hash of
the document and put in order, so that neither chunks, masks nor steps depend on how the
table is partitioned. Chunks go on from the round's parameters, and theirs are averaged.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from streamlookup.llm.caches import give_back
from streamlookup.llm.words import hashes_of
from streamlookup.sources.shared import written

# Buckets of words; the last number stands for the places beyond a document's ends.
BUCKETS = 1 << 16
EDGE = BUCKETS

# The most frequent buckets, by which others are told apart, and the size of their vectors.
MARKS = 64
VECTOR = 16

# Words on each side, and sizes of the network's layers.
SIDE = 3
AROUND = [i for i in range(-SIDE, SIDE + 1) if i]
HIDDEN = 32
EXPERTS = 32

# Groups of buckets that are met together; a window belongs to one.
GROUPS = 8

# Share of a word's whole frequency in each expert, next to what the expert has seen.
PLAIN = 0.05

# Rounds, each masking its share of the words, words in a step, and the rate of the steps.
ROUNDS = 2
STEP_WORDS = 1024
RATE = 0.01

# Bytes of text dealt together, and the words at which their row is cut.
SHARD_BYTES = 1 << 20
CHUNK_WORDS = 1 << 18

# Shards that a task encodes, and the most tasks.
TASK_SHARDS, MOST_TASKS = 48, 1 << 16

# Words scored at once.
SCORE_WORDS = 8192

_SHAPES = {
    "mix": (2 * SIDE * VECTOR, HIDDEN),
    "mix_bias": (HIDDEN,),
    "out": (HIDDEN, EXPERTS),
    "out_bias": (EXPERTS,),
}
_SIZES = {name: int(np.prod(shape)) for name, shape in _SHAPES.items()}
N_WEIGHTS = sum(_SIZES.values())

SCORES = "doc_id long, n_words long, log_prob double, mean_log_prob double"


class Room:
    """Arrays by name that step after step writes to: a new one of their size is made of pages
    that the system zeroes first, which takes longer than most sums over it."""

    def __init__(self):
        self.kept: dict[str, np.ndarray] = {}

    def array(self, name: str, kind: np.dtype, rows: int, *columns: int) -> np.ndarray:
        kept = self.kept.get(name)
        if kept is None or len(kept) < rows:
            kept = self.kept[name] = np.empty((rows, *columns), kind)
        return kept[:rows]

    def rows_of(self, name: str, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        """The rows of ``table`` at the valid ``index``."""
        found = self.array(name, table.dtype, len(index), *index.shape[1:], *table.shape[1:])
        return np.take(table, index, axis=0, out=found, mode="clip")  # other modes go by way of a new array

    def __reduce__(self):
        return Room, ()


class Network:
    """Parameters as views into one flat array.

    What :meth:`forward` and :meth:`gradient` give per word is overwritten by the next call."""

    def __init__(self, flat: np.ndarray, kind: type = np.float32):
        self.flat = np.ascontiguousarray(flat, kind)
        self.room = Room()
        at = 0
        for name, shape in _SHAPES.items():
            setattr(self, name, self.flat[at : at + _SIZES[name]].reshape(shape))
            at += _SIZES[name]

    @classmethod
    def initial(cls, shares: np.ndarray, seed: int = 0) -> Network:
        """Small random weights; the constants are the experts' log shares."""
        net = cls(np.random.default_rng(seed).normal(0, 0.1, N_WEIGHTS))
        net.mix_bias[:] = 0
        net.out_bias[:] = np.log(shares)
        return net

    def _array(self, name: str, rows: int, columns: int) -> np.ndarray:
        return self.room.array(name, self.flat.dtype, rows, columns)

    def forward(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and weights of the experts; ``seen`` has a row of vectors per word."""
        hidden = np.matmul(seen, self.mix, out=self._array("hidden", len(seen), HIDDEN))
        hidden += self.mix_bias
        np.tanh(hidden, out=hidden)
        weights = np.matmul(hidden, self.out, out=self._array("weights", len(seen), EXPERTS))
        weights += self.out_bias
        weights -= weights.max(axis=1, keepdims=True)
        np.exp(weights, out=weights)
        weights /= weights.sum(axis=1, keepdims=True)
        return hidden, weights

    def log_probs(self, seen: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """Log-probability of each word's bucket; ``chances`` has those of the experts."""
        return np.log(np.einsum("ij,ij->i", self.forward(seen)[1], chances))

    def gradient(self, seen: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean negative log-probability, as one flat array, and each word's
        shares of the experts once the word is known."""
        found = Network(np.empty_like(self.flat), self.flat.dtype.type)
        hidden, weights = self.forward(seen)
        shares = np.multiply(weights, chances, out=self._array("shares", len(seen), EXPERTS))
        shares /= shares.sum(axis=1, keepdims=True)
        slope = np.subtract(weights, shares, out=weights)
        slope /= len(seen)
        back = np.matmul(slope, self.out.T, out=self._array("back", len(seen), HIDDEN))
        bend = np.multiply(hidden, hidden, out=self._array("bend", len(seen), HIDDEN))
        back *= np.subtract(1, bend, out=bend)
        found.out[:] = hidden.T @ slope
        found.out_bias[:] = slope.sum(axis=0)
        found.mix[:] = seen.T @ back
        found.mix_bias[:] = back.sum(axis=0)
        return found.flat, shares


class Adam:
    """Steps of one chunk, from the round's parameters on."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.n = net, rate, 0
        self.mean = np.zeros_like(net.flat)
        self.square = np.zeros_like(net.flat)

    def step(self, seen: np.ndarray, chances: np.ndarray) -> np.ndarray:
        g, shares = self.net.gradient(seen, chances)
        self.n += 1
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.001 * (g * g - self.square)
        size = np.sqrt(self.square / (1 - 0.999**self.n)) + 1e-8
        self.net.flat -= self.rate * (self.mean / (1 - 0.9**self.n)) / size
        return shares


def word_hashes(text: str | None) -> np.ndarray:
    """The hash of each word; A-Z count as lower case."""
    return hashes_of((text or "").encode().lower().split())


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.uint16)


ENCODED = "chunk long, doc_ids array<long>, sizes binary, words binary, hashes binary"


def _encoded(docs: DataFrame) -> DataFrame:
    """Rows of many documents: their words as numbers of the row's distinct hashes,
    which are in order, and the documents' sizes.

    Which documents share a row, and in which order, depends on the documents alone.
    """
    arrow = to_arrow_schema(_parse_datatype_string(ENCODED))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(shard: int, n: int, doc_ids: list, held: list[np.ndarray]) -> pa.RecordBatch:
            hashes, words = np.unique(np.concatenate(held), return_inverse=True)
            sizes = np.array([len(x) for x in held], np.int32).tobytes()
            values = [(shard << 24) + n, doc_ids, sizes, packed(words.astype(numbers_of(len(hashes)))), hashes.tobytes()]
            return batch_of([values], arrow)

        rows = (row for batch in batches for row in zip(*batch.columns))
        for shard, group in groupby(rows, key=lambda row: row[2].as_py()):
            doc_ids, held, size, n = [], [], 0, 0
            for doc_id, text, _ in group:
                doc_ids.append(doc_id.as_py())
                held.append(word_hashes(text.as_py()))
                size += len(held[-1])
                if size >= CHUNK_WORDS:
                    yield row(shard, n, doc_ids, held)
                    doc_ids, held, size, n = [], [], 0, n + 1
            if held:
                yield row(shard, n, doc_ids, held)

    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    shards = size // SHARD_BYTES + 1
    key = F.xxhash64("doc_id", "text")
    dealt = docs.select("doc_id", "text", F.pmod(key, F.lit(shards)).alias("shard"), key.alias("key"))
    tasks = min(MOST_TASKS, -(-shards // TASK_SHARDS))
    dealt = dealt.repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard", "key", "doc_id")
    return written(dealt.select("doc_id", "text", "shard").mapInArrow(encode, ENCODED), "words")


def batch_of(rows: list, arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


# How arrays are stored: their size in bytes, then the numbers' first bytes, second
# bytes and so on, compressed.
_CODEC = "zstd"


def packed(values: np.ndarray) -> bytes:
    parts = np.ascontiguousarray(values).reshape(-1).view(np.uint8).reshape(-1, values.itemsize).T
    return values.nbytes.to_bytes(8) + pa.compress(parts.tobytes(), codec=_CODEC, asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8])
    parts = np.frombuffer(pa.decompress(data[8:], size, codec=_CODEC, asbytes=True), np.uint8)
    return np.ascontiguousarray(parts.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def numbers_of(n: int) -> type:
    """The type of numbers below ``n``."""
    return np.uint16 if n <= 1 << 16 else np.uint32


class Chunk:
    """A row of :func:`_encoded`; its buckets may stand for the hashes."""

    def __init__(self, row: dict):
        self.row, self.id = row, row["chunk"]
        if "buckets" in row:
            self.buckets = unpacked(row["buckets"], np.uint16)
        else:
            self.hashes = np.frombuffer(row["hashes"], np.uint64)
            self.buckets = buckets_of(self.hashes)
        self.words = unpacked(row["words"], numbers_of(len(self.buckets))).astype(np.int32)
        self.sizes = np.frombuffer(row["sizes"], np.int32)

    def masked(self, i: int, rounds: int) -> np.ndarray:
        """The words masked in round ``i``, in random order: each word is in one round."""
        rng = np.random.default_rng(self.id)
        order = rng.permutation(len(self.words))
        return order[i::rounds]

    def line(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all words with places beyond the ends between documents, and
        where the words are."""
        documents = np.repeat(np.arange(len(self.sizes)), self.sizes)
        at = np.arange(len(self.words)) + SIDE * (documents + 1)
        line = np.full(len(self.words) + SIDE * (len(self.sizes) + 1), EDGE, np.int32)
        line[at] = self.buckets[self.words]
        return line, at

    def windows(self, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The buckets in the places around each chosen word, those before it first."""
        line, at = self.line()
        at = at[chosen]
        return np.stack([line[at + i] for i in AROUND], axis=1)

    def sums(self, values: np.ndarray) -> list[float]:
        """Each document's sum of its words' ``values``."""
        ends = np.cumsum(np.r_[0, self.sizes])
        total = np.r_[0.0, np.cumsum(values)]
        return (total[ends[1:]] - total[ends[:-1]]).tolist()


@cache
def one_thread() -> None:
    """Products of small matrices take twice the CPU time if numpy spreads them over threads,
    and a task has one core: tell the OpenBLAS of numpy's wheels, where there is one."""
    for file in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        if tell := getattr(ctypes.CDLL(str(file)), "scipy_openblas_set_num_threads64_", None):
            tell(1)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    one_thread()
    give_back()
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(batch.slice(i, 1).to_pylist()[0])


# Numbers in a row of what tasks add up: a thousand rows, which go to Python at once, are 16 MB at most.
BLOCK = 1 << 11

# Rows that leave a task at once.
ROWS_OUT = 16

# Rows that Python takes out of a batch at once.
FEW_AT_ONCE = 64


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The batches' rows; Python holds no second copy of a whole batch."""
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, FEW_AT_ONCE):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, FEW_AT_ONCE).columns))


def summed(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, kind: type = np.float64) -> np.ndarray:
    """The sum of the ``size`` numbers that each task gives out, as ``kind``.

    Spark adds them up block by block; only as many as one task gives come to the driver,
    a number that does not depend on the input.
    """
    schema = "block int, data binary"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = run(batches)
        parts = ((block, values[at : at + BLOCK]) for block, at in enumerate(range(0, size, BLOCK)))
        rows = ((block, packed(part.astype(kind))) for block, part in parts if part.any())
        while some := [*islice(rows, ROWS_OUT)]:
            yield batch_of(some, arrow)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the blocks dealt to the task, whose number does not depend on the input: no sort needed.
        totals: dict[int, np.ndarray] = {}
        for block, data in rows_of(batches):
            part = unpacked(data, kind)
            if block in totals:
                totals[block] += part
            else:
                totals[block] = part.astype(np.float64)
        rows = ((block, packed(total)) for block, total in totals.items())
        while some := [*islice(rows, ROWS_OUT)]:
            yield batch_of(some, arrow)

    total = np.zeros(size)
    for block, data in df.mapInArrow(give, schema).repartition("block").mapInArrow(add, schema).collect():
        part = unpacked(data, np.float64)
        total[block * BLOCK : block * BLOCK + len(part)] = part
    return total


def count_buckets(encoded: DataFrame) -> np.ndarray:
    """How often each bucket occurs in the whole corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(BUCKETS)
        for chunk in chunks(batches):
            n = np.bincount(chunk.words, minlength=len(chunk.buckets))
            total += np.bincount(chunk.buckets, weights=n, minlength=BUCKETS)
        return total

    return summed(encoded, count, BUCKETS)


def count_neighbours(encoded: DataFrame, counts: np.ndarray) -> np.ndarray:
    """How often each bucket has each mark in its window, in the whole corpus."""
    mark = np.full(BUCKETS + 1, MARKS, np.int32)
    mark[np.lexsort((np.arange(BUCKETS), -counts))[:MARKS]] = np.arange(MARKS)
    shared = encoded.sparkSession.sparkContext.broadcast(mark)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((BUCKETS + 1) * MARKS, np.int32)  # the last ones for the places beyond the ends
        for chunk in chunks(batches):
            line, _ = chunk.line()
            marks = shared.value.take(line)
            at = np.flatnonzero(marks < MARKS)  # words, so no neighbour is beyond the line
            found = marks[at]
            for i in AROUND:
                # The number's type is that of the sums: any other takes ten times as long.
                np.add.at(total, line[at - i].astype(np.int64) * MARKS + found, np.int32(1))
        return total[: BUCKETS * MARKS]

    found = summed(encoded, count, BUCKETS * MARKS, np.int32).reshape(BUCKETS, MARKS)
    shared.unpersist()
    return found


def centres(points: np.ndarray, weights: np.ndarray, n: int, steps: int = 15) -> np.ndarray:
    """Weighted k-means; begins with points far from those before."""
    rng = np.random.default_rng(0)
    found = points[[int(np.argmax(weights))]]
    far = ((points - found[0]) ** 2).sum(axis=1)
    for _ in range(n - 1):
        chance = np.cumsum(far * weights)
        at = int(np.searchsorted(chance, rng.random() * chance[-1])) if chance[-1] else 0
        found = np.vstack([found, points[min(at, len(points) - 1)]])
        far = np.minimum(far, ((points - found[-1]) ** 2).sum(axis=1))
    for _ in range(steps):
        of = nearest(points, found)
        size = np.bincount(of, weights=weights, minlength=n)
        for d in range(points.shape[1]):
            moved = np.bincount(of, weights=weights * points[:, d], minlength=n)
            found[:, d] = np.where(size > 0, moved / np.maximum(size, 1e-9), found[:, d])
    return found


def nearest(points: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.argmin((found * found).sum(axis=1) - 2 * points @ found.T, axis=1)


class Buckets:
    """What the corpus' counts say of each bucket: its vector, its group's vote, and its
    chance with each expert before any training. The last vector and vote, those of the
    places beyond the ends, are zero."""

    def __init__(self, counts: np.ndarray, neighbours: np.ndarray):
        self.share = (counts + 1) / (counts + 1).sum()
        near = neighbours.sum(axis=1, keepdims=True)
        usual = (neighbours.sum(axis=0) + 1) / (neighbours.sum() + MARKS)
        # Log of how much more often than usual, near nothing for what is rare.
        ratio = np.log((neighbours + 8 * usual) / ((near + 8) * usual))
        weights = np.sqrt(counts)
        axes = np.linalg.eigh((ratio * weights[:, None]).T @ ratio)[1][:, ::-1][:, :VECTOR]
        points = ratio @ axes
        scale = np.sqrt((points**2 * self.share[:, None]).sum(axis=0)) + 1e-6
        self.vectors = np.vstack([points / scale, np.zeros(VECTOR)]).astype(np.float32)

        found = centres(points, weights, EXPERTS)
        of = nearest(points, found)
        own = np.full((BUCKETS, EXPERTS), 0.2 / EXPERTS)
        own[np.arange(BUCKETS), of] += 0.8
        self.seen = own * (counts[:, None] + 1e-3)
        sizes = np.bincount(of, weights=counts, minlength=EXPERTS)
        group = nearest(found, centres(found, np.sqrt(sizes + 1), GROUPS))[of]
        self.votes = np.zeros((BUCKETS + 1, GROUPS), np.float32)
        self.votes[np.arange(BUCKETS), group] = (near / (near + 8))[:, 0]


def chances_of(seen: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The experts as distributions over buckets, from the sums of what they have seen."""
    return ((1 - PLAIN) * seen / seen.sum(axis=0) + PLAIN * share[:, None]).astype(np.float32)


class Model:
    """The network, the experts' distributions, and the buckets' vectors and votes.

    ``met`` says how often each bucket occurs in windows of each group."""

    met: np.ndarray

    def __init__(self, net: Network, chances: np.ndarray, vectors: np.ndarray, votes: np.ndarray):
        self.net, self.chances, self.vectors, self.votes = net, chances, vectors, votes
        self.room = Room()

    def seen(self, context: np.ndarray) -> np.ndarray:
        """The vectors of each word's window in a row, overwritten by the next call."""
        return self.room.rows_of("seen", self.vectors, context).reshape(len(context), -1)

    def chances_in(self, buckets: np.ndarray) -> np.ndarray:
        """The experts' chances of each bucket, overwritten by the next call."""
        return self.room.rows_of("chances", self.chances, buckets)

    def groups(self, chunk: Chunk) -> np.ndarray:
        """The group that most words of each word's window belong to."""
        line, at = chunk.line()
        votes = self.votes.take(line, axis=0)
        n = len(line) - 2 * SIDE
        total = np.zeros((n, GROUPS), np.float32)
        for i in AROUND:
            total += votes[SIDE + i : SIDE + i + n]
        return np.argmax(total, axis=1)[at - SIDE]

    def log_probs(self, chunk: Chunk, context: np.ndarray) -> np.ndarray:
        """Log-probability of each word's bucket, given its window."""
        found = np.empty(len(context))
        buckets = chunk.buckets[chunk.words]
        for at in range(0, len(context), SCORE_WORDS):
            part = slice(at, at + SCORE_WORDS)
            found[part] = self.net.log_probs(self.seen(context[part]), self.chances_in(buckets[part]))
        return found


# Rows up to which a sum is made with those of the others, place by place.
FEW_ROWS = 8


def sums_from(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``np.add.reduceat`` down the rows from each ``first`` on, up to the next. Most sums are of few rows,
    of which it takes each number by itself; added row by row they come out the same."""
    sizes = np.diff(np.r_[first, len(rows)])
    total = np.zeros((len(first), rows.shape[1]), rows.dtype)
    for i in range(1, FEW_ROWS):
        at = np.flatnonzero((sizes > i) & (sizes <= FEW_ROWS))
        total[at] += rows.take(first[at] + i, axis=0)
    total += rows.take(first, axis=0)
    if len(many := np.flatnonzero(sizes > FEW_ROWS)):
        ends = np.stack([first[many], np.minimum(first[many] + sizes[many], len(rows) - 1)], axis=1).ravel()
        found = np.add.reduceat(rows, ends, axis=0)[::2]
        if first[many[-1]] + sizes[many[-1]] == len(rows):
            found[-1] = np.add.reduceat(rows[first[many[-1]] :], [0], axis=0)[0]
        total[many] = found
    return total


def train_round(encoded: DataFrame, model: Model, i: int, rounds: int, rate: float) -> tuple[Network, np.ndarray]:
    """One pass of every chunk over the words it masks in this round: the chunks' networks
    averaged by their words, and what each expert has seen of each bucket."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def train(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        model = shared.value
        seen = np.zeros((BUCKETS, EXPERTS), np.float32)
        weights, words = np.zeros(N_WEIGHTS), 0
        for chunk in chunks(batches):
            chosen = chunk.masked(i, rounds)
            if not len(chosen):
                continue
            own = Adam(Network(model.net.flat.copy()), rate)
            context, buckets = chunk.windows(chosen), chunk.buckets[chunk.words[chosen]]
            shares = np.empty((len(chosen), EXPERTS), np.float32)
            for at in range(0, len(chosen), STEP_WORDS):
                part = slice(at, at + STEP_WORDS)
                shares[part] = own.step(model.seen(context[part]), model.chances_in(buckets[part]))
            order = np.argsort(buckets, kind="stable")
            distinct, first = np.unique(buckets[order], return_index=True)
            seen[distinct] += sums_from(shares.take(order, axis=0), first)
            weights += own.net.flat * float(len(chosen))
            words += len(chosen)
        return np.concatenate([np.r_[weights, words].astype(np.float32), seen.ravel()])

    total = summed(encoded, train, N_WEIGHTS + 1 + BUCKETS * EXPERTS, np.float32)
    shared.unpersist()
    weights, words, seen = total[:N_WEIGHTS], total[N_WEIGHTS], total[N_WEIGHTS + 1 :].reshape(BUCKETS, EXPERTS)
    return (Network(weights / words) if words else model.net), seen


def count_groups(encoded: DataFrame, model: Model) -> np.ndarray:
    """How often each bucket occurs in windows of each group, in the whole corpus."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(BUCKETS * GROUPS)
        for chunk in chunks(batches):
            own = chunk.buckets[chunk.words].astype(np.int32) * GROUPS
            total += np.bincount(own + shared.value.groups(chunk), minlength=len(total))
        return total

    found = summed(encoded, count, BUCKETS * GROUPS).reshape(BUCKETS, GROUPS)
    shared.unpersist()
    return found


def initial_model(encoded: DataFrame) -> tuple[Model, Buckets]:
    """What the counts alone give."""
    counts = count_buckets(encoded)
    buckets = Buckets(counts, count_neighbours(encoded, counts))
    net = Network.initial(buckets.seen.sum(axis=0) / buckets.seen.sum())
    return Model(net, chances_of(buckets.seen, buckets.share), buckets.vectors, buckets.votes), buckets


def train_model(encoded: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model trained over all documents; without words it stays as it began."""
    model, buckets = initial_model(encoded)
    total = np.zeros((BUCKETS, EXPERTS))
    for i in range(rounds):
        net, seen = train_round(encoded, model, i, rounds, RATE / (1 + 2 * i))
        total += seen
        # An expert that has seen hardly anything keeps to what it began with.
        known = total + buckets.seen * 1e-3
        model = Model(net, chances_of(known, buckets.share), model.vectors, model.votes)
    return model


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_prob`` and ``mean_log_prob`` (per word) of each document.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A text that is
    NULL or has no words scores 0, with a NULL mean. Repeated rows have a row each; an
    empty table gives none. Scores do not depend on how the table is partitioned, but for the
    last digits of sums; they do depend on the other documents.
    """
    from streamlookup.llm.lm_words import with_words, word_log_probs

    encoded = _encoded(docs)
    model = train_model(encoded, rounds)
    model.met = count_groups(encoded, model)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model))
    arrow = to_arrow_schema(_parse_datatype_string(SCORES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value[1]
        for chunk in chunks(batches):
            sums = chunk.sums(model.log_probs(chunk, chunk.windows()) + word_log_probs(model, chunk))
            sizes = chunk.sizes.tolist()
            means = [s / n if n else None for s, n in zip(sums, sizes)]
            found = [chunk.row["doc_ids"], sizes, [s if n else 0.0 for s, n in zip(sums, sizes)], means]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(found, arrow)], schema=arrow)

    return with_words(encoded, model, run, SCORES)
