"""Near-duplicates by circulant MinHash.

A text is the set of its five-word shingles. Two permutations give all coordinates
of its signature: the first places the shingles, the second, shifted by one place
for each coordinate, orders them. Bands of coordinates propose candidates, whose
full sets decide.

Texts with the same set are one class from the start, so that copies make no pairs.
Classes that share a band are first compared with one of them, the one with most
company; what the links found this way leave apart is compared in blocks, inside
tasks, which give out only links that join what was not joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_groups, map_slices
from streamlookup.llm.components import connected_components
from streamlookup.llm.words import hashes_of, mixed
from streamlookup.operators.sizing import fits
from streamlookup.sources.shared import written

SHINGLE_WORDS = 5
COORDINATES = 160

# Places of the permutations: shingles that share one are not told apart by the
# signature, which can only add candidates.
PLACES = 1 << 20
_SEED = 20240229

# Chance with which a linked pair may share no band.
MISS = 1e-7

# A pair is compared if its signatures agree in so much less than the threshold
# that a linked one does not (standard deviations of the estimate).
DEVIATIONS = 5.5

# Shingles whose sets one task compares at once.
BLOCK_SHINGLES = 200_000

# Signatures that one task compares at once.
BLOCK_CLASSES = 2_000

_MULTIPLIERS = np.array([xxhash.xxh3_64_intdigest(b"shingle", seed=i) | 1 for i in range(SHINGLE_WORDS)], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes.

    Words are runs of anything but ASCII white space, with A-Z in lower case. A text
    of fewer than five words has one shingle, all its words; one without words
    has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    found, n = hashes_of(words), len(words) - SHINGLE_WORDS + 1
    runs = found[:n] * _MULTIPLIERS[0]
    for i in range(1, SHINGLE_WORDS):
        runs += found[i : n + i] * _MULTIPLIERS[i]
    return np.unique(mixed(runs))


@lru_cache(maxsize=1)
def _permutations() -> np.ndarray:
    """The second permutation; row i has its values from place i on, in a circle."""
    order = np.random.default_rng(_SEED).permutation(PLACES).astype(np.uint32)
    circle = np.concatenate([order, order[:COORDINATES]])
    return np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)


def signature(found: np.ndarray, part: int = 4096) -> np.ndarray:
    """The least value of a set under every shift of the second permutation. The
    first permutation is the mixing that made the hashes: their low bits are places."""
    rows = _permutations()
    least = np.full(COORDINATES, PLACES, np.uint32)
    places = (found & np.uint64(PLACES - 1)).astype(np.int64)
    for at in range(0, len(places), part):
        np.minimum(least, rows[places[at : at + part]].min(axis=0), out=least)
    return least


def band_rows(threshold: float) -> int:
    """Coordinates of a band: as many as leave a linked pair without a common band
    with a chance of ``MISS`` at most."""
    fitting = [r for r in range(1, 33) if (1 - threshold**r) ** (COORDINATES // r) <= MISS]
    if not fitting:
        raise ValueError(f"no bands find pairs of similarity {threshold}")
    return max(fitting)


def bands(least: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per band, different for different bands."""
    n = COORDINATES // rows
    parts = least[: n * rows].astype(np.uint64).reshape(n, rows)
    keys = np.arange(1, n + 1, dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return keys


def least_agreement(threshold: float) -> float:
    return threshold - DEVIATIONS * (threshold * (1 - threshold) / COORDINATES) ** 0.5


SIGNED = "doc_id long, text_key long, n_shingles long, class binary, bands binary, sketch binary"


def signatures(docs: DataFrame, threshold: float) -> DataFrame:
    """Size of the set, class (hash of the whole set), bands and sketch (a byte per
    coordinate) of each document."""
    rows = band_rows(threshold)

    def sign(doc_ids: list, texts: list, keys: list) -> dict:
        sets = [shingles(text) for text in texts]
        least = [signature(s) for s in sets]
        return {
            "doc_id": doc_ids,
            "text_key": keys,
            "n_shingles": [len(s) for s in sets],
            "class": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "bands": [bands(m, rows).astype("<i8").tobytes() if len(s) else None for s, m in zip(sets, least)],
            "sketch": [m.astype("u1").tobytes() if len(s) else None for s, m in zip(sets, least)],
        }

    return map_slices(docs.select("doc_id", "text", F.xxhash64("text")), sign, SIGNED)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def near_duplicates(docs: DataFrame, percent: int = 80, with_first: bool = False) -> DataFrame:
    """Components of documents linked by 100 * common >= ``percent`` * all shingles.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Returns per row
    ``doc_id``, ``n_shingles``, ``component_id`` (the smallest ``doc_id`` that can be
    reached, its own included) and ``kept`` (whether that is its own). A text that is
    NULL, empty or without words is linked with nothing. Rows with the same ``doc_id``
    are all kept or all not, each in the component of its text; a NULL ``doc_id`` counts
    as larger than any, and such a row is kept only if its component has no other id.
    An empty table gives no row. ``with_first`` adds ``text_key``, xxhash64 of the text, and
    ``first``, the id and text key of the component's first document (NULL for texts without words).
    """
    threshold = percent / 100
    signed = written(signatures(docs, threshold), "signatures")
    # Ids before rows without one.
    first = [F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")] if with_first else []
    classes = signed.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct("doc_id", "text_key", "n_shingles", "bands", "sketch")).alias("s"),
        F.min("doc_id").alias("least_id"),
        *first,
    )
    added = ["first"] if with_first else []
    classes = written(classes.select("class", "least_id", *added, "s.*"), "classes")
    roots = _roots(docs, classes, percent)

    in_component = classes.join(roots, F.col("class") == F.col("node"), "left")
    root = F.coalesce("root", "class")
    ids = in_component.select("class", root.alias("root"), "least_id", *added)
    least = ids.groupBy("root").agg(F.min("least_id").alias("component_id"), *[F.min(c).alias(c) for c in added])
    components = ids.drop(*added).join(least, "root").select("class", "component_id", *added)
    key = ["text_key"] if with_first else []
    found = signed.select("doc_id", *key, "n_shingles", "class").join(components, "class", "left")
    # Texts without words have no class, and are a component each.
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", *key, *added, "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _roots(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``root`` of the classes that are linked with others."""
    buckets = _buckets(classes, percent)
    leaders = _leader_pairs(buckets, classes, percent)
    roots = connected_components(_confirmed(docs, leaders, classes, percent))
    rest = _rest(buckets, roots, classes, percent)
    more = written(_compared(docs, rest, classes, percent), "more-links")
    if more.isEmpty():
        return roots
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return connected_components(known.unionByName(more))


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """``bucket``, ``class``, ``n_shingles`` for the bands that several classes have."""
    each = 8
    n = COORDINATES // band_rows(percent / 100)
    at = F.sequence(F.lit(0), F.lit(n - 1))
    keys = F.transform(at, lambda i: F.substring(F.col("bands"), 1 + each * i, F.lit(each)))
    rows = classes.select("class", "n_shingles", F.explode(keys).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return written(rows.join(shared, "bucket"), "buckets")


def _leader_pairs(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the one of its bucket that has most company over all buckets."""
    company = buckets.groupBy("class").agg(F.sum("size").alias("company"))
    ranked = buckets.join(company, "class")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("company", "class"))["class"].alias("leader"))
    pairs = buckets.join(leaders, "bucket").where(F.col("class") != F.col("leader"))
    pairs = pairs.select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct()
    return written(_alike(pairs, classes, percent), "pairs")


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and signatures do not rule out a link."""
    agree = int(least_agreement(percent / 100) * COORDINATES)

    @F.arrow_udf("boolean")
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(s.to_pylist()), "u1").reshape(-1, COORDINATES) for s in (a, b))
        return pa.array((left == right).sum(axis=1) >= agree)

    for side in "ab":
        own = classes.select(F.col("class").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n_shingles").alias(f"n_{side}"))
        pairs = pairs.join(own, side)
    size = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.where(size).where(alike("sketch_a", "sketch_b")).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """``class`` and ``shingles`` of the wanted classes, made anew from one text each."""
    ids = classes.join(wanted.distinct(), "class", "left_semi").select(
        "class", F.col("doc_id").alias("wanted_id"), F.col("text_key").alias("wanted_key")
    )
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("key") == F.col("wanted_key"))
    texts = texts.join(ids, same).select("class", "text")

    def make(names: list, found: list) -> dict:
        return {"class": names, "shingles": [shingles(text).tobytes() for text in found]}

    # Rows repeated with their id come several times.
    sets = map_slices(texts, make, "class binary, shingles binary")
    return sets.groupBy("class").agg(F.first("shingles").alias("shingles"))


def _confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked by their full sets."""
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    sets = written(_sets(docs, wanted, classes), "sets")

    def confirm(a: list, b: list, left: list, right: list) -> dict:
        linked = [_linked(_set(x), _set(y), percent) for x, y in zip(left, right)]
        return {"a": [x for x, ok in zip(a, linked) if ok], "b": [x for x, ok in zip(b, linked) if ok]}

    for side in "ab":
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return map_slices(pairs.select("a", "b", "set_a", "set_b"), confirm, "a binary, b binary")


def _rest(buckets: DataFrame, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``bucket`` and ``class`` (with ``root`` and ``n_shingles``) of what may still be
    linked across components.

    Of each bucket that has classes of several components, the signatures are
    compared, in blocks; a pair is looked at in the first band it shares only. Blocks whose sizes rule out a
    link do not meet, nor do those of the bucket's largest component among themselves.
    """
    rows, agree = band_rows(percent / 100), int(least_agreement(percent / 100) * COORDINATES)
    labelled = buckets.join(roots, F.col("class") == F.col("node"), "left").select(
        "bucket", "class", F.coalesce("root", "class").alias("root"), "n_shingles"
    )
    mixed_ones = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    several = _block_pairs(labelled.join(mixed_ones.select("bucket"), "bucket"), F.lit(1), BLOCK_CLASSES, percent)
    several = several.join(classes.select("class", "bands", "sketch"), "class")
    n = COORDINATES // rows

    def look(group: dict[str, tuple]) -> Iterator[tuple]:
        members = len(group["class"])
        if members < 2:
            return
        # A row per coordinate: comparing one class with all others runs along them.
        sketch = np.ascontiguousarray(np.frombuffer(b"".join(group["sketch"]), "u1").reshape(-1, COORDINATES).T)
        keys = np.frombuffer(b"".join(group["bands"]), "<i8").reshape(-1, n)
        size, block = np.array(group["n_shingles"]), np.array(group["block"])
        numbers = {root: i for i, root in enumerate(dict.fromkeys(group["root"]))}
        root = np.array([numbers[r] for r in group["root"]])
        band = int(np.flatnonzero(keys[0] == np.frombuffer(group["bucket"][0], "<i8")[0])[0])
        across = group["one"][0] != group["other"][0]
        needed = np.zeros(members, bool)
        for i in range(members - 1):
            rest = slice(i + 1, None)
            fits = (root[rest] != root[i]) & (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))
            if across:
                fits &= block[rest] != block[i]
            if not fits.any():
                continue
            same = (sketch[:, rest] == sketch[:, i : i + 1]).view("u1").sum(axis=0, dtype="u1")
            at = i + 1 + np.flatnonzero(fits & (same >= agree))
            if band:
                at = at[~(keys[at, :band] == keys[i, :band]).any(axis=1)]
            if len(at):
                needed[i] = True
                needed[at] = True
        for i in np.flatnonzero(needed).tolist():
            yield tuple(group[c][i] for c in ("bucket", "class", "root", "n_shingles"))

    found = map_groups(several, ["bucket", "one", "other"], look, "bucket binary, class binary, root binary, n_shingles long")
    return written(found.distinct(), "rest")


# Blocks of a part of a bucket are numbered below this.
_BLOCKS = 1 << 32


def _block_pairs(rows: DataFrame, weight, limit: int, percent: int) -> DataFrame:
    """Deal each bucket's rows into blocks of about ``limit`` in ``weight``, and copy them to pairs of blocks,
    ``one`` <= ``other``, so that any two rows that may be linked across components meet in one pair.

    A bucket within the limit is one block. The rows of a larger one are parted by size, in steps of the ratio
    below which two sets cannot be linked: only rows of the same or neighbouring steps meet. Apart from that, rows of the
    bucket's largest component meet only those of others.
    """
    rows = rows.withColumn("weight", weight.cast("long"))
    by_root = rows.groupBy("bucket", "root").agg(F.sum("weight").alias("weight"))
    large = by_root.groupBy("bucket").agg(
        F.sum("weight").alias("total"), F.max(F.struct("weight", "root"))["root"].alias("largest")
    )
    large = large.where(F.col("total") > limit).drop("total")
    # A hair wider than the ratio, so that rounding cannot part two that may be linked.
    step = F.floor(F.log(F.col("n_shingles")) / F.lit(np.log(100 / percent) * (1 + 1e-9))).cast("long")
    rows = rows.join(large, "bucket", "left").withColumn("step", F.when(F.col("largest").isNotNull(), step).otherwise(F.lit(0)))
    rows = rows.withColumn("main", F.coalesce(F.col("root") == F.col("largest"), F.lit(False))).drop("largest")

    parts = rows.groupBy("bucket", "step", "main").agg(F.ceil(F.sum("weight") / limit).alias("n"))
    near = parts.select("bucket", F.explode(F.array(*[F.col("step") + i for i in (-1, 0, 1)])).alias("step"), F.col("step").alias("of"), "main", "n")
    part = lambda at, main: F.max(F.when((F.col("of") == F.col("step") + at) & (F.col("main") == main), F.col("n")))
    counts = near.groupBy("bucket", "step").agg(
        *[F.coalesce(part(at, main), F.lit(0)).alias(f"n_{at + 1}_{int(main)}") for at in (-1, 0, 1) for main in (False, True)]
    )
    rows = rows.join(counts, ["bucket", "step"])

    def blocks(at: int, main: bool):
        """The blocks of a part that this row meets."""
        first, n = ((F.col("step") + at) * 2 + int(main)) * _BLOCKS, F.col(f"n_{at + 1}_{int(main)}")
        met = n > 0 if not main else (n > 0) & ~F.col("main")
        return F.when(met, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1), lambda i: first + i))

    own = (F.col("step") * 2 + F.col("main").cast("long")) * _BLOCKS
    own += F.pmod(F.xxhash64("class"), F.when(F.col("main"), F.col("n_1_1")).otherwise(F.col("n_1_0")))
    empty = F.array().cast("array<bigint>")
    met = F.concat(*[F.coalesce(blocks(at, main), empty) for at in (-1, 0, 1) for main in (False, True)])
    rows = rows.withColumn("block", own).withColumn("with", F.explode(met))
    helpers = ["weight", "step", "main", "with", *[f"n_{at}_{main}" for at in range(3) for main in range(2)]]
    return rows.withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with")).drop(*helpers)


def _compared(docs: DataFrame, rest: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links across components inside the rest of each bucket, by full sets.

    A task counts the common shingles of one class with all others at once, from
    lists of the classes that have a shingle.
    """
    rows = _block_pairs(rest, F.col("n_shingles"), BLOCK_SHINGLES, percent)
    rows = rows.join(_sets(docs, rest.select("class"), classes), "class")

    def compare(group: dict[str, tuple]) -> Iterator[tuple]:
        numbers = {root: i for i, root in enumerate(dict.fromkeys(group["root"]))}
        sets, roots = [_set(data) for data in group["shingles"]], [numbers[r] for r in group["root"]]
        for i, j in _joining(sets, roots, percent):
            yield group["class"][i], group["class"][j]

    return map_groups(rows, ["bucket", "one", "other"], compare, "a binary, b binary")


def _joining(sets: list[np.ndarray], root: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """Links between sets of different roots that join what is not joined yet."""
    parent = list(range(max(root, default=-1) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    size = np.array([len(s) for s in sets])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.r_[0, np.cumsum(np.bincount(code, minlength=len(values)))]
    who = np.repeat(np.arange(len(sets), dtype=np.int32), size)[np.argsort(code, kind="stable")]
    del values
    ends = np.r_[0, np.cumsum(size)]
    for i in range(len(sets) - 1):
        own = code[ends[i] : ends[i + 1]]
        both = np.zeros(len(sets), np.int64)
        for c in range(0, len(own), 1024):
            part = own[c : c + 1024]
            n = first[part + 1] - first[part]
            at = np.repeat(first[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            both += np.bincount(who[at], minlength=len(sets))
        linked = np.flatnonzero(100 * both >= percent * (size + size[i] - both))
        for j in linked[linked > i].tolist():
            a, b = find(root[i]), find(root[j])
            if a != b:
                parent[a] = b
                yield i, j


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each component of ``near_duplicates``, with all its columns.

    The one with the smallest ``doc_id`` stays (a NULL comes last; of several texts with that id the one
    with the smaller hash), and of rows that repeat its id and text one. Texts without words are in no
    component and all stay. Only those that go are joined, by id and text: as a broadcast if
    they are few enough, else by a shuffle. Rows of an id and text that come several times are shuffled, the rest are not.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    found = near_duplicates(docs, percent, with_first=True).where(F.col("first").isNotNull())
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    rows = written(found.groupBy("doc_id", "text_key", chosen.alias("chosen")).count(), "near-duplicates")

    def same(others: DataFrame):
        return doc_id.eqNullSafe(others["doc_id"]) & (F.xxhash64(text) == others["text_key"])

    def ids(which) -> DataFrame:
        found = rows.where(which).select("doc_id", "text_key")
        return F.broadcast(found) if fits(found) else found

    gone = ids(~F.col("chosen"))
    kept = plain.join(gone, same(gone), "left_anti")
    several = F.col("chosen") & (F.col("count") > 1)
    if not rows.where(several).isEmpty():
        again = ids(several)
        once = kept.join(again, same(again), "left_semi").withColumn("_key", F.xxhash64(text))
        once = once.dropDuplicates([names[docs.columns.index("doc_id")], "_key"]).drop("_key")
        kept = kept.join(again, same(again), "left_anti").unionByName(once)
    return kept.toDF(*docs.columns)
