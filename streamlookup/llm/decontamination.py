"""Benchmark decontamination by greedy string tiling.

Runs of a few words that a document shares with a benchmark item are seeds. Where
there are any, the two are tiled: the longest match of words not covered yet is
marked again and again, found by running Karp-Rabin hashes, until none has the
least length. An item whose words are covered to a share by tiles is in the
document, also if its passages come in another order or with others between them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_slices
from streamlookup.llm.words import RunningHash, hashes_of, mixed, plain_words
from streamlookup.sources.shared import written

# Words of the shortest tile, and of a seed; fewer only if the whole item has fewer.
LEAST_MATCH = 5

# Share of an item's words that tiles must cover.
COVERAGE = 0.6

# Words of benchmark items that a pass over the documents takes along. A larger
# benchmark is taken in several passes, which bounds what is sent to executors.
BLOCK_WORDS = 2_000_000

MATCHES = "doc_id long, item_id long, n_item_words long, n_covered long, n_tiles long, coverage double"


def tile(doc: np.ndarray, item: np.ndarray, least: int = LEAST_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes.

    Returns tiles ``(start in doc, start in item, words)``, the longest first, which
    overlap neither in the document nor in the item. Of equally long ones the
    first in the item is taken, at its first place in the document.
    """
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    doc_hash, item_hash = RunningHash(doc), RunningHash(item)

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of uncovered runs of that length that both have, and those in the document's hashes."""
        places = _uncovered(free_doc, length)
        in_doc, in_item = doc_hash.runs(length)[places], item_hash.runs(length)
        items = _uncovered(free_item, length)
        shared = np.isin(in_doc, in_item[items])
        return places[shared], items[np.isin(in_item[items], in_doc)], in_doc[shared]

    tiles: list[tuple[int, int, int]] = []
    longest = min(len(doc), len(item))
    while True:
        # A run in common has all its shorter runs in common, so the longest is found by halving.
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
        if low < least:
            return tiles
        longest = low
        places, items, hashes = common(longest)
        marked = False
        for j in items.tolist():
            if not free_item[j : j + longest].all():
                continue
            for i in places[hashes == item_hash.runs(longest)[j]].tolist():
                if free_doc[i : i + longest].all() and (doc[i : i + longest] == item[j : j + longest]).all():
                    tiles.append((i, j, longest))
                    free_doc[i : i + longest] = free_item[j : j + longest] = False
                    marked = True
                    break
        if not marked:  # equal hashes of unlike words
            longest -= 1


def _uncovered(free: np.ndarray, length: int) -> np.ndarray:
    """Places of runs of that length that no tile covers."""
    if length > len(free):
        return np.empty(0, np.int64)
    n = np.r_[0, np.cumsum(free)]
    return np.flatnonzero(n[length:] - n[:-length] == length)


class Benchmark:
    """Items as word hashes, and the hashes of their seeds in order.

    A seed has ``least`` words; that of a shorter item is the whole item.
    """

    def __init__(self, item_ids: list, texts: list, least: int):
        self.least = least
        self.ids, self.items = [], []
        by_length: dict[int, list[int]] = {}
        for item_id, text in zip(item_ids, texts):
            words = hashes_of(plain_words(text))
            if len(words):
                by_length.setdefault(min(least, len(words)), []).append(len(self.items))
                self.ids.append(item_id)
                self.items.append(words)
        self.seeds = {n: self._seeds(n, numbers) for n, numbers in sorted(by_length.items())}

    def _seeds(self, length: int, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        seeds = [mixed(RunningHash(self.items[i]).runs(length)) for i in numbers]
        owners = np.repeat(numbers, [len(s) for s in seeds])
        seeds = np.concatenate(seeds)
        order = np.argsort(seeds, kind="stable")
        return seeds[order], owners[order]

    def tilings(self, text: str | None) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """The items that share a seed with the text, and their tiles."""
        if not self.seeds:
            return
        words = hashes_of(plain_words(text))
        hashes = RunningHash(words)
        for length, (seeds, owners) in self.seeds.items():
            runs = mixed(hashes.runs(length))
            first = np.searchsorted(seeds, runs)
            places = np.flatnonzero(seeds[np.minimum(first, len(seeds) - 1)] == runs)
            if not len(places):
                continue
            last = np.searchsorted(seeds, runs[places], side="right")
            n = last - first[places]
            # All items that have the seed at each place.
            at = np.repeat(places, n)
            inside = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            owner = owners[np.repeat(first[places], n) + inside]
            order = np.argsort(owner, kind="stable")
            for same in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
                item = int(owner[same[0]])
                yield item, tile(_part(words, np.unique(at[same]), length), self.items[item], length)


def _part(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The stretches of a document that seeds cover. Each is followed by a
    value that no word has, so that no tile goes on into the next."""
    parts = []
    for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
        parts += [words[run[0] : run[-1] + length], np.array([len(parts)], np.uint64)]
    return np.concatenate(parts)


def _blocks(benchmark: DataFrame, block_words: int) -> tuple[int, Iterator[list[Row]]]:
    """The items, in blocks of about so many words, and how many blocks there are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Letters may be words: a text without blanks weighs as much as it has bytes.
    weight = F.greatest(F.size(F.split(text, r"\W+")), F.octet_length(text) / 6).cast("long")
    items = benchmark.select("item_id", "text", weight.alias("n"))
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return blocks, (items.where(part == i).collect() if blocks > 1 else items.collect() for i in range(blocks))


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST_MATCH, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """A row per document and item whose words are covered to ``coverage`` or more.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``;
    other columns are not read. Texts without words match nothing. An item of fewer than
    ``least`` words has to occur whole, as one tile; in scripts without blanks each letter is a
    word. Repeated documents and items have a row each. Without documents or items there is no row.

    Documents are not shuffled: the items go to them, in blocks of bounded size. Of several
    blocks each has its pass over the documents, whose matches are stored, and is released then.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    blocks, parts = _blocks(benchmark, block_words)
    found = None
    for items in parts:
        shared = _share(spark, items)
        matches = map_slices(docs, _matcher(shared, least, coverage), MATCHES)
        if blocks > 1:
            matches = written(matches, "matches")
            shared.unpersist()
        found = matches if found is None else found.unionByName(matches)
    return found


def _matcher(shared, least: int, coverage: float):
    def match(doc_ids: list, texts: list) -> dict:
        items = _benchmark(shared, least)
        rows = []
        for doc_id, text in zip(doc_ids, texts):
            for item, tiles in items.tilings(text):
                covered, total = sum(t[2] for t in tiles), len(items.items[item])
                if covered >= coverage * total:
                    rows.append((doc_id, items.ids[item], total, covered, len(tiles), covered / total))
        names = [c.split()[0] for c in MATCHES.split(", ")]
        return dict(zip(names, zip(*rows) if rows else [()] * len(names)))

    return match


def _share(spark: SparkSession, items: list[Row]):
    return spark.sparkContext.broadcast((uuid.uuid4().hex, [r["item_id"] for r in items], [r["text"] for r in items]))


_benchmarks: dict[tuple[str, int], Benchmark] = {}


def _benchmark(shared, least: int) -> Benchmark:
    """The worker's benchmark, made once for a broadcast; only the last is kept."""
    name, item_ids, texts = shared.value
    if (name, least) not in _benchmarks:
        _benchmarks.clear()
        _benchmarks[name, least] = Benchmark(item_ids, texts, least)
    return _benchmarks[name, least]


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.

    A flag is worked out where the document is; nothing is joined or shuffled. Of several blocks
    of items each is released when what it leaves is stored. Documents with a NULL or empty
    text stay, repeated ones too.
    """
    least, coverage = options.get("least", LEAST_MATCH), options.get("coverage", COVERAGE)
    spark, names = docs.sparkSession, docs.columns
    kept = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    blocks, parts = _blocks(benchmark, options.get("block_words", BLOCK_WORDS))
    for items in parts:
        shared = _share(spark, items)
        kept = kept.where(~_holds(shared, least, coverage)(F.col(text)))
        if blocks > 1:
            kept = written(kept, "clean")
            shared.unpersist()
    return kept.toDF(*names)


def _holds(shared, least: int, coverage: float):
    match = _matcher(shared, least, coverage)

    @F.arrow_udf("boolean")
    def holds(texts: pa.Array) -> pa.Array:
        found = set(match(list(range(len(texts))), texts.to_pylist())["doc_id"])
        return pa.array([i in found for i in range(len(texts))], pa.bool_())

    return holds
