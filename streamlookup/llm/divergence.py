"""Divergence of the sources of each language, by a K-squared quadtree over group-term counts.

Rows of the matrix are groups (a source in a language), columns the terms that the
language keeps. Spark cuts it into blocks of groups and terms. Inside a block a quadtree
(K-squared tree, K = 2) holds only quadrants that have a count. All pairs of groups
go down the tree together: where both have an all-zero quadrant, its
terms are priced at once, as absent terms have one probability per group; at the leaves the
probabilities are compared cell by cell, a leaf with all rows at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from streamlookup.llm.batches import map_groups
from streamlookup.operators.sizing import fits
from streamlookup.sources.shared import written

# Documents of its language that a kept term is in.
LEAST_DOCS = 10

# Terms reported of a group.
TOP_TERMS = 10

# Probabilities are in units of 1e-9, and each count has 2 added.
UNIT = 10**9
ADDED = 2

# Distinct terms a worker counts before it hands its counts on.
HELD_TERMS = 200_000

# Groups on a side, and cells, of a block of the matrix (on average).
BLOCK_GROUPS = 256
BLOCK_CELLS = 100_000

# Rows and columns of a leaf are 2 to this power.
LEAF_BITS = 5

# ASCII letters, in lower case, and all bytes of other characters make terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)

COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = "part string, lang string, source string, item string, value long, covered long, absent long, kept_terms long"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM_BYTES).split() if text else []


def term_counts(docs: DataFrame) -> DataFrame:
    """Counts of each term in each group, and of the documents that have it: partial ones,
    several per term, to be added up. Nothing is shuffled yet."""
    schema = to_arrow_schema(_parse_datatype_string(COUNTS))

    def batches_of(counted: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, found) in counted.items():
            names = pa.array(list(counts), pa.binary()).cast(pa.string())
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), len(names)),
                pa.repeat(pa.scalar(source, pa.string()), len(names)),
                names,
                pa.array(counts.values(), pa.int64()),
                pa.array(map(found.__getitem__, counts), pa.int64()),
            ]
            yield from pa.table(columns, schema=schema).to_batches(max_chunksize=10_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not (terms := terms_of(text)):
                    continue
                counts, found = counted.setdefault((lang, source), (Counter(), Counter()))
                held -= len(counts)
                counts.update(terms)
                found.update(set(terms))
                held += len(counts)
                if held >= HELD_TERMS:
                    yield from batches_of(counted)
                    counted, held = {}, 0
        yield from batches_of(counted)

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(count, COUNTS)


def kept_cells(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The counts above 0 of kept terms: ``lang``, ``source``, ``term``, ``n``, ``term_total`` (over all sources) and
    ``first`` (true for one cell of each term)."""
    cells = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy("lang", "term")
    cells = cells.select(
        *("lang", "source", "term", "n"),
        F.sum("n").over(term).alias("term_total"),
        F.sum("docs").over(term).alias("term_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    )
    return cells.where(F.col("term_docs") >= least_docs).drop("term_docs")


class Quadtree:
    """A K-squared tree: levels of nodes, each with four children or none for an all-zero quadrant."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray):
        self.cells = rows, columns, counts
        leaf_rows, leaf_columns = rows >> LEAF_BITS, columns >> LEAF_BITS
        side = int(max(leaf_rows.max(initial=0), leaf_columns.max(initial=0)))
        self.levels = side.bit_length()
        code = np.zeros(len(rows), np.int64)  # bits of row and column in turn
        for bit in range(self.levels):
            code |= ((leaf_rows >> bit & 1) << (2 * bit + 1)) | ((leaf_columns >> bit & 1) << (2 * bit))
        self.order = np.argsort(code, kind="stable")
        nodes, first = np.unique(code[self.order], return_index=True)
        self.first = np.append(first, len(rows))
        self.children: list[np.ndarray] = []
        for _ in range(self.levels):
            above = np.unique(nodes >> 2)
            table = np.full((len(above), 4), -1, np.int64)
            table[np.searchsorted(above, nodes >> 2), nodes & 3] = np.arange(len(nodes))
            self.children.insert(0, table)
            nodes = above

    @property
    def root(self) -> int:
        return 0 if len(self.order) else -1

    def child(self, level: int, node: int, quadrant: int) -> int:
        return -1 if node < 0 else int(self.children[level][node, quadrant])

    def leaf(self, node: int, rows: int, columns: int) -> np.ndarray:
        """A leaf's counts; all zero for a missing one."""
        dense = np.zeros((rows, columns), np.int64)
        if node >= 0:
            at = self.order[self.first[node] : self.first[node + 1]]
            own_rows, own_columns, counts = (c[at] for c in self.cells)
            mask = (1 << LEAF_BITS) - 1
            dense[own_rows & mask, own_columns & mask] = counts
        return dense


def probabilities(counts: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """``1 + floor(UNIT * (count + ADDED) / mass)`` with a mass per row, exactly at any size."""
    if int(counts.max(initial=0)) + ADDED >= 2**63 // UNIT:
        counts, mass = counts.astype(object), mass.astype(object)
    return (1 + UNIT * (counts + ADDED) // mass.reshape(-1, *[1] * (counts.ndim - 1))).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Audit:
    """One block: its groups' pairwise divergences, and each group's terms above the language's rate."""

    def __init__(self, tree: Quadtree, columns: int, mass: np.ndarray, term_totals: np.ndarray, lang_mass: int):
        self.tree, self.n_columns, self.mass = tree, columns, mass
        self.n_rows = len(mass)
        self.absent = probabilities(np.zeros(self.n_rows, np.int64), mass)
        self.typical = probabilities(term_totals.reshape(1, -1), np.array([lang_mass]))[0]
        self.total = np.zeros((self.n_rows, self.n_rows), np.int64)
        self.zeros = np.zeros((self.n_rows, self.n_rows), np.int64)
        self.above: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def run(self) -> None:
        # The tree is square: what lies beyond the matrix is never entered.
        top = max(self.tree.levels, (max(self.n_rows - 1, 0) >> LEAF_BITS).bit_length())
        self._visit(top, self.tree.root, self.tree.root, 0, 0, 0)
        self.total += self.zeros * divergence(self.absent[:, None], self.absent[None, :])

    def _visit(self, height: int, a: int, b: int, row_a: int, row_b: int, column: int) -> None:
        """Rows from ``row_a`` with rows from ``row_b``, both ranges ``side`` long, over as many columns from ``column``."""
        side = 1 << (height + LEAF_BITS)
        columns = min(side, self.n_columns - column)
        if row_a >= self.n_rows or row_b >= self.n_rows or columns <= 0:
            return
        rows = slice(row_a, min(row_a + side, self.n_rows)), slice(row_b, min(row_b + side, self.n_rows))
        if a < 0 and b < 0:
            self.zeros[rows] += columns
        elif height == 0:
            self._compare(a, b, rows, column, columns)
        else:
            half = side >> 1
            level = self.tree.levels - height
            for i in range(2):
                for j in range(2):
                    if row_a == row_b and j < i:
                        continue
                    for k in range(2):
                        left, right = self._below(level, a, 2 * i + k), self._below(level, b, 2 * j + k)
                        self._visit(height - 1, left, right, row_a + i * half, row_b + j * half, column + k * half)

    def _below(self, level: int, node: int, quadrant: int) -> int:
        if level < 0:  # above the tree's own root, which is the first quadrant
            return node if quadrant == 0 else -1
        return self.tree.child(level, node, quadrant)

    def _compare(self, a: int, b: int, rows: tuple[slice, slice], column: int, columns: int) -> None:
        own, other = (self.tree.leaf(n, r.stop - r.start, columns) for n, r in zip((a, b), rows))
        p, q = (probabilities(counts, self.mass[r]) for counts, r in zip((own, other), rows))
        for i in range(len(p)):
            self.total[rows[0].start + i, rows[1]] += divergence(p[i], q).sum(axis=1)
        if rows[0] == rows[1]:
            typical = self.typical[column : column + columns]
            row, at = np.nonzero((own > 0) & (p > typical))
            self.above.append((row + rows[0].start, at + column, divergence(p[row, at], typical[at])))


def _audit_block(block: dict[str, tuple]) -> Iterator[tuple]:
    """Rows of ``PARTS`` of one block; its groups' headers have no term."""
    lang, diagonal = block["lang"][0], block["one"][0] == block["other"][0]
    headers = [i for i, term in enumerate(block["term"]) if term is None]
    cells = [i for i, term in enumerate(block["term"]) if term is not None]
    groups = [block["source"][i] for i in headers]
    kept, lang_mass = block["kept_terms"][headers[0]], block["lang_mass"][headers[0]]
    mass = np.array([block["n"][i] + ADDED * kept for i in headers], np.int64)
    side = [block["block"][i] for i in headers]
    # Frequent terms first, so that what is not zero lies together.
    totals = {block["term"][i]: block["term_total"][i] for i in cells}
    terms = sorted(totals, key=totals.__getitem__, reverse=True)
    number, row = {term: i for i, term in enumerate(terms)}, {g: i for i, g in enumerate(groups)}
    found = Quadtree(
        np.array([row[block["source"][i]] for i in cells], np.int64),
        np.array([number[block["term"][i]] for i in cells], np.int64),
        np.array([block["n"][i] for i in cells], np.int64),
    )
    audit = Audit(found, len(terms), np.maximum(mass, 1), np.array([totals[t] for t in terms], np.int64), max(lang_mass, 1))
    audit.run()
    absent = divergence(audit.absent[:, None], audit.absent[None, :])
    for i, one in enumerate(groups):
        for j in range(i + 1, len(groups)):
            if diagonal or side[i] != side[j]:
                value, zero = (int(table[i, j]) for table in (audit.total, absent))
                yield "pair", lang, one, groups[j], value, len(terms), zero, kept
                yield "pair", lang, groups[j], one, value, len(terms), zero, kept
    if diagonal and audit.above:
        rows, columns, values = (np.concatenate(c) for c in zip(*audit.above))
        by_name = np.empty(len(terms), np.int64)
        by_name[sorted(range(len(terms)), key=lambda i: terms[i].encode())] = np.arange(len(terms))
        order = np.lexsort((by_name[columns], -values, rows))
        rows, columns, values = rows[order], columns[order], values[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        for i in np.flatnonzero(place < TOP_TERMS).tolist():
            yield "term", lang, groups[rows[i]], terms[columns[i]], int(values[i]), 0, 0, kept


def _blocks(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells and group headers, dealt into blocks: every two groups of a language meet
    in one block (``one``, ``other``) of each part of its terms (``part``)."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("lang_cells") * F.col("sides") / BLOCK_CELLS)).cast("long")
    sides = F.ceil(F.col("lang_groups") / BLOCK_GROUPS).cast("long")
    langs = groups.select("lang", "lang_cells", "lang_groups").distinct()
    langs = written(langs.withColumn("sides", sides).withColumn("parts", parts).drop("lang_cells", "lang_groups"), "langs")
    if fits(langs):
        langs = F.broadcast(langs)
    at = F.pmod(F.xxhash64("term"), F.col("parts"))
    none = F.lit(None)
    listed = groups.join(langs, "lang").select(
        "lang", "source", none.cast("string").alias("term"), "n", none.cast("long").alias("term_total"),
        "kept_terms", "lang_mass", "sides", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
    )
    counted = cells.join(langs, "lang").select(
        "lang", "source", "term", "n", "term_total", none.cast("long").alias("kept_terms"),
        none.cast("long").alias("lang_mass"), "sides", at.alias("part"),
    )
    rows = listed.unionByName(counted).withColumn("block", F.pmod(F.xxhash64("source"), F.col("sides")))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    return rows.withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with")).drop("sides", "with")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """How far the sources of each language are apart in their terms.

    Reads ``text``, ``lang`` and ``source``; a NULL counts as ''. A language keeps the terms that are
    in ``least_docs`` of its documents or more. With N occurrences of V kept terms, a
    group gives a term p = 1 + floor(1e9 * (count + 2) / (N + 2 V)); two probabilities are
    floor((p - q)^2 / (p + q)) apart, all in exact integers.

    Returns ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` (from 1 per group and part, by value descending,
    then by item). Part ``pair`` has every other source of the language, with the sum over all kept terms (0 if
    there are none); part ``term`` the ten terms of a group that exceed the language's p most. An empty
    table gives no row; a group without terms has its pairs. Repeated rows count as often as they are there.

    Terms are counted inside tasks before the shuffle, so a large source or a frequent term is a few rows
    per task. A block has about ``BLOCK_CELLS`` cells and at most twice some ``BLOCK_GROUPS`` groups.
    """
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    docs = docs.select(*named, "text")
    cells = written(kept_cells(docs, least_docs), "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = cells.groupBy("lang").agg(
        F.sum("n").alias("lang_n"), F.count_if("first").alias("kept_terms"), F.count(F.lit(1)).alias("lang_cells")
    )
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["n", "lang_n", "kept_terms", "lang_cells"])
    groups = groups.withColumn("lang_groups", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    groups = groups.withColumn("lang_mass", F.col("lang_n") + ADDED * F.col("kept_terms"))
    blocks = _blocks(written(groups, "groups"), cells)
    found = written(map_groups(blocks, ["lang", "part", "one", "other"], _audit_block, PARTS), "audited")

    # Terms that a block does not have are absent in both groups there.
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        (F.sum("value") + (F.max("kept_terms") - F.sum("covered")) * F.max("absent")).alias("value")
    )
    terms = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(terms)
