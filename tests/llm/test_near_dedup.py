from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamlookup.llm import near_dedup as nd
from streamlookup.llm.components import connected_components


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows, percent):
    """Rows of (doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets = [plain_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for shingle in s for j in where[shingle])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for shingle in s:
            where[shingle].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return Counter((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def found(docs, percent):
    return Counter(map(tuple, nd.near_duplicates(docs, percent).collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_sets(sample):
    odd = ["", None, " \x0b\x1c", "A b", "a  B\t", "é É", "a b c d e", "x\x85y z", "a b c d e f a b c d e", "K"]
    texts = odd + [r["text"] for r in sample[:60]]
    sets = [plain_set(t) for t in texts]
    hashed = [nd.shingles(t) for t in texts]
    assert [len(h) for h in hashed] == [len(s) for s in sets]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(hashed[i], hashed[j])) == len(sets[i] & sets[j])


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.85):
        close = []
        for _ in range(20):
            a = rng.integers(0, 2**64, 2000, np.uint64)
            b = a.copy()
            n = round(2000 * (1 - share) / (1 + share))
            b[:n] = rng.integers(0, 2**64, n, np.uint64)
            close.append((nd.signature(a) == nd.signature(b)).mean())
        assert abs(np.mean(close) - share) < 0.03


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_bands_find_linked_pairs(percent):
    rows, share = nd.band_rows(percent / 100), percent / 100
    assert (1 - share**rows) ** (nd.COORDINATES // rows) <= nd.MISS
    assert nd.least_agreement(share) < share


@pytest.mark.parametrize("percent", [80, 85])
def test_documents(spark, sample, percent):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    assert found(frame(spark, rows), percent) == brute_force(rows, percent)


def variants(rng, base, n, changes):
    """Copies of a text with some words replaced by new ones."""
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice(changes)):
            words[at] = f"v{rng.random()}"
        out.append(" ".join(words))
    return out


def group_rows(seed, n=60):
    """Groups of near copies around the threshold, chains, and exact copies."""
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"w{rng.random()}" for _ in range(rng.randint(80, 200))]
        texts += variants(rng, base, n, range(0, 6))
        chain = list(base)
        for _ in range(10):  # each like the one before, the ends unlike
            for at in rng.sample(range(len(chain)), 2):
                chain[at] = f"c{rng.random()}"
            texts.append(" ".join(chain))
        texts += [" ".join(base)] * 5
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("blocks", [(2_000, 500_000), (40, 2_000)])
def test_groups(spark, monkeypatch, blocks):
    monkeypatch.setattr(nd, "BLOCK_CLASSES", blocks[0])
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", blocks[1])
    rows = group_rows(blocks[0])
    expected = brute_force(rows, 85)
    assert found(frame(spark, rows), 85) == expected
    assert len({c for _, _, c, _ in expected}) > 4


def bucket_rows(spark, sizes, main_root):
    """A bucket: a class per size; ``main_root`` says which belong to its largest component."""
    rows = [(b"bucket", f"c{i}".encode(), b"main" if main_root(i) else f"r{i}".encode(), n) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "bucket binary, class binary, root binary, n_shingles long")


@pytest.mark.parametrize("percent", [80, 85])
def test_blocks_meet_where_a_link_is_possible(spark, percent):
    rng = random.Random(percent)
    sizes = [round(100 * 1.005 ** rng.randrange(500)) for _ in range(400)]
    rows = bucket_rows(spark, sizes, lambda i: i % 3 == 0)
    found = nd._block_pairs(rows, F.lit(1), 40, percent)
    assert set(found.columns) == {"bucket", "class", "root", "n_shingles", "block", "one", "other"}
    groups = {}
    for r in found.collect():
        groups.setdefault((r["one"], r["other"]), {})[int(r["class"][1:])] = r["block"]
    met = set()
    for (one, other), members in groups.items():
        assert set(members.values()) <= {one, other} and len(members) < 200
        for i, a in members.items():
            met |= {(i, j) for j, b in members.items() if i < j and (one == other or a != b)}
    possible = {
        (i, j) for i in range(400) for j in range(i + 1, 400)
        if 100 * min(sizes[i], sizes[j]) >= percent * max(sizes[i], sizes[j]) and (i % 3 or j % 3)
    }
    assert possible <= met
    # A few times fewer rows than if each class met every block.
    blocks = -(-400 // 40)
    assert sum(map(len, groups.values())) < 0.6 * 400 * blocks


def test_a_hot_bucket_of_one_component_is_hardly_copied(spark):
    """Of a thousand classes all but five are linked already: each is copied for the others' block only."""
    rows = bucket_rows(spark, [300] * 1000, lambda i: i >= 5)
    found = nd._block_pairs(rows, F.lit(1), 50, 85)
    assert found.count() < 1.2 * 1000
    small = nd._block_pairs(rows, F.lit(1), 5000, 85).collect()
    assert len(small) == 1000 and {(r["one"], r["other"], r["block"]) for r in small} == {(0, 0, 0)}


def test_links_that_the_leaders_miss(spark):
    """Without leaders all links come from the comparison in blocks."""
    rows = group_rows(9, n=30)
    docs = frame(spark, rows)
    classes = nd.signatures(docs, 0.85).selectExpr("class", "n_shingles", "bands", "sketch", "doc_id", "text_key").dropDuplicates(["class"])
    buckets = nd._buckets(classes, 85)
    nobody = spark.createDataFrame([], "node binary, root binary")
    links = nd._compared(docs, nd._rest(buckets, nobody, classes, 85), classes, 85)
    roots = {bytes(r.node): bytes(r.root) for r in connected_components(links).collect()}
    ids = defaultdict(set)
    for r in nd.signatures(docs, 0.85).select("doc_id", "class").collect():
        ids[roots.get(bytes(r["class"]), bytes(r["class"]))].add(r.doc_id)
    component = {d: min(group) for group in ids.values() for d in group}
    assert component == {d: c for d, _, c, _ in brute_force(rows, 85)}


def test_odd_documents(odd_docs):
    docs, rows = odd_docs
    expected = Counter()
    for (d, n, c, _), k in brute_force(rows, 85).items():
        expected[d, n, c, d == c] += k
    assert found(docs, 85) == expected


def test_no_documents(no_docs):
    assert nd.near_duplicates(no_docs).collect() == []
    assert nd.keep_one_of_each(no_docs).collect() == []


def test_one_of_each_stays(odd_docs):
    docs, rows = odd_docs
    kept = nd.keep_one_of_each(docs)
    assert kept.schema == docs.schema
    # 8 is a copy of 7; of the repeated rows of 1 one stays.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 9]


def test_one_of_repeated_rows_stays(spark):
    text = "one and the same text of more than five words"
    near = "w " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text), (2, text), (None, "a text that nobody gave an id to"),
            (None, "a text that nobody gave an id to"), (None, near), (None, near + " x"), (5, near + " y"),
            (7, "same id but another text, also of some length"), (7, "same id but another text, also of some length indeed it is"),
            (8, ""), (8, ""), (9, None), (9, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row long")
    kept = sorted((r.doc_id or 0, r.text or "") for r in nd.keep_one_of_each(docs).collect())
    # Texts without words are in no group; the two texts of 7 are not alike enough.
    assert kept == sorted([(1, text), (0, rows[4][1]), (5, near + " y"), (7, rows[9][1]), (7, rows[10][1]), (8, ""), (8, ""), (9, ""), (9, "")])


def test_of_a_group_without_ids_one_stays(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(None, " ".join(words[:n])) for n in (198, 199, 200)] + [(3, " ".join(words) + " a"), (3, " ".join(words) + " b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in nd.keep_one_of_each(docs).collect()] == [3]
    assert nd.keep_one_of_each(docs.where("doc_id IS NULL")).count() == 1


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (60, 200)]
    links += [(b, a) for a, b in rng.sample(links, 30)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    expected = {i: 0 for i in range(51)} | {100 + i: 100 for i in range(40)} | {60: 60, 200: 60}
    assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
