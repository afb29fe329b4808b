from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streamlookup.llm import lm_scoring as lm
from streamlookup.llm import lm_words as words

from .conftest import SF_DIR


def documents(spark, sample, parts=3):
    rows = [(r["doc_id"], r["text"]) for r in sample]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def read(df):
    return [lm.Chunk(r.asDict()) for r in df.collect()]


def random_model(seed):
    rng = np.random.default_rng(seed)
    chances = rng.random((lm.BUCKETS, lm.EXPERTS)) ** 8
    vectors = np.vstack([rng.normal(size=(lm.BUCKETS, lm.VECTOR)), np.zeros(lm.VECTOR)])
    votes = np.vstack([rng.random((lm.BUCKETS, lm.GROUPS)), np.zeros(lm.GROUPS)])
    net = lm.Network(rng.normal(0, 0.3, lm.N_WEIGHTS))
    return lm.Model(net, (chances / chances.sum(axis=0)).astype(np.float32), vectors.astype(np.float32), votes.astype(np.float32))


def test_steps_use_their_arrays_again():
    """Smaller ones too; the numbers are those of new arrays."""
    model, rng = random_model(3), np.random.default_rng(4)
    net, made = model.net, {}
    for rows in (50, 50, 20):
        context = rng.integers(0, lm.BUCKETS + 1, (rows, 2 * lm.SIDE))
        buckets = rng.integers(0, lm.BUCKETS, rows)
        seen, chances = model.seen(context), model.chances_in(buckets)
        assert (seen == model.vectors[context].reshape(rows, -1)).all() and (chances == model.chances[buckets]).all()
        hidden = np.tanh(seen.astype(np.float32) @ net.mix + net.mix_bias)
        weights = np.exp(hidden @ net.out + net.out_bias)
        weights /= weights.sum(axis=1, keepdims=True)
        found = net.forward(seen.astype(np.float32))
        assert np.allclose(found[0], hidden, atol=1e-5) and np.allclose(found[1], weights, atol=1e-5)
        for name, array in zip(("seen", "chances", "hidden", "weights"), (seen, chances, *found)):
            assert np.shares_memory(made.setdefault(name, array), array)


@pytest.mark.parametrize("sizes", [[1], [9], [3, 1, 20, 2], [40, 8, 9, 1], [1, 30, 30]])
def test_sums_of_few_rows_are_those_of_reduceat(sizes):
    """Bit by bit, whichever sum is the last."""
    rows = np.random.default_rng(5).random((sum(sizes), 4)).astype(np.float32)
    first = np.cumsum([0, *sizes[:-1]])
    assert (lm.sums_from(rows, first) == np.add.reduceat(rows, first, axis=0)).all()


def test_gradient():
    rng = np.random.default_rng(0)
    net = lm.Network(rng.normal(0, 0.3, lm.N_WEIGHTS), np.float64)
    seen, chances = rng.normal(size=(40, 2 * lm.SIDE * lm.VECTOR)), rng.random((40, lm.EXPERTS))
    slope, shares = net.gradient(seen, chances)
    assert np.allclose(shares.sum(axis=1), 1)
    for i in rng.choice(len(slope), 80, replace=False):
        values = []
        for step in (1e-5, -1e-5):
            net.flat[i] += step
            values.append(-net.log_probs(seen, chances).mean())
            net.flat[i] -= step
        assert abs((values[0] - values[1]) / 2e-5 - slope[i]) < 1e-6


def test_chances_of_all_buckets_add_up():
    model = random_model(1)
    seen = model.seen(np.random.default_rng(2).integers(0, lm.BUCKETS + 1, (1, 2 * lm.SIDE)))
    weights = model.net.forward(seen)[1]
    assert abs((model.chances.astype(float) @ weights[0]).sum() - 1) < 1e-4
    share = np.random.default_rng(3).random(lm.BUCKETS)
    found = lm.chances_of(np.random.default_rng(4).random((lm.BUCKETS, lm.EXPERTS)), share / share.sum())
    assert np.allclose(found.sum(axis=0), 1, atol=1e-4) and (found > 0).all()


def test_chances_of_a_buckets_words_add_up():
    rng = np.random.default_rng(0)
    hashes = np.unique(rng.integers(0, 40, 300).astype(np.uint64) << np.uint64(48) | rng.integers(0, 1 << 40, 300).astype(np.uint64))
    counts = rng.integers(0, 9, (len(hashes), lm.GROUPS)).astype(float)
    counts[:, 0] += 1
    bucket = (hashes >> np.uint64(48)).astype(int)
    whole = np.stack([np.bincount(bucket, weights=c) for c in counts.T], axis=1)
    found = np.exp(words.shares_in(counts, whole[bucket]))
    for b in np.unique(bucket):
        assert np.allclose(found[bucket == b].sum(axis=0), 1)


def plain_scores(model, texts, tables):
    """Word by word: the window, the network in double precision, the mixture, the word's share."""
    for text in texts:
        hashes = lm.word_hashes(text).tolist()
        line = [lm.EDGE] * lm.SIDE + [h >> 48 for h in hashes] + [lm.EDGE] * lm.SIDE
        total = 0.0
        for i, h in enumerate(hashes):
            around = line[i : i + lm.SIDE] + line[i + lm.SIDE + 1 : i + 2 * lm.SIDE + 1]
            seen = [float(x) for b in around for x in model.vectors[b]]
            hidden = np.tanh(np.array(seen) @ model.net.mix.astype(float) + model.net.mix_bias)
            scores = np.exp(hidden @ model.net.out.astype(float) + model.net.out_bias)
            chance = sum(s / scores.sum() * float(c) for s, c in zip(scores, model.chances[h >> 48]))
            group = int(np.argmax(sum(model.votes[b] for b in around)))
            total += math.log(chance) + tables[h][group]
        yield total


def plain_table(model, texts):
    """Each word's log share of its bucket's count in each group, from plain dictionaries."""
    counts: dict[int, list[float]] = {}
    for text in texts:
        hashes = lm.word_hashes(text).tolist()
        line = [lm.EDGE] * lm.SIDE + [h >> 48 for h in hashes] + [lm.EDGE] * lm.SIDE
        for i, h in enumerate(hashes):
            around = line[i : i + lm.SIDE] + line[i + lm.SIDE + 1 : i + 2 * lm.SIDE + 1]
            group = int(np.argmax(sum(model.votes[b] for b in around)))
            counts.setdefault(h, [0.0] * lm.GROUPS)[group] += 1
    buckets: dict[int, list[float]] = {}
    for h, c in counts.items():
        buckets[h >> 48] = [a + b for a, b in zip(buckets.get(h >> 48, [0.0] * lm.GROUPS), c)]
    found = {}
    for h, c in counts.items():
        whole = buckets[h >> 48]
        plain = sum(c) / sum(whole)
        found[h] = [math.log((x + words.PLAIN_COUNT * plain) / (w + words.PLAIN_COUNT)) for x, w in zip(c, whole)]
    return found


def test_scores_word_by_word(spark, sample, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    texts = {r["doc_id"]: r["text"] for r in sample[:60]}
    docs = documents(spark, sample[:60])
    known = lm._encoded(docs)
    model = random_model(6)
    model.met = lm.count_groups(known, model)
    chunks = read(words.with_words(known, model))
    assert len(chunks) > 1 and sum(c.row["n_words"] for c in chunks) == len({w for t in texts.values() for w in (t or "").encode().lower().split()})
    found = {}
    for c in chunks:
        found.update(zip(c.row["doc_ids"], c.sums(model.log_probs(c, c.windows()) + words.word_log_probs(model, c))))
    expected = dict(zip(texts, plain_scores(model, texts.values(), plain_table(model, texts.values()))))
    assert found.keys() == expected.keys()
    for doc_id, total in expected.items():
        n = len((texts[doc_id] or "").split())
        assert abs(found[doc_id] - total) < 1e-3 * max(n, 1)


def test_counts(spark, sample):
    encoded = lm._encoded(documents(spark, sample))
    counts = np.zeros(lm.BUCKETS)
    lines = [(lm.word_hashes(r["text"]) >> np.uint64(48)).astype(int).tolist() for r in sample]
    for line in lines:
        np.add.at(counts, line, 1)
    assert (lm.count_buckets(encoded) == counts).all()
    marks = np.lexsort((np.arange(lm.BUCKETS), -counts))[: lm.MARKS].tolist()
    place = {b: i for i, b in enumerate(marks)}
    expected = np.zeros((lm.BUCKETS, lm.MARKS))
    for line in lines:
        for i, b in enumerate(line):
            for other in line[max(0, i - lm.SIDE) : i] + line[i + 1 : i + 1 + lm.SIDE]:
                if other in place:
                    expected[b, place[other]] += 1
    assert (lm.count_neighbours(encoded, counts) == expected).all()


def test_scoring_has_one_worker_a_task(spark, sample):
    """Rows are put together and scored in one step: two would need two workers at the same time."""
    plan = lm.score_documents(documents(spark, sample[:20]), rounds=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and plan.split("Exchange")[0].count("MapInArrow") == 1


def test_rows_leave_a_batch_a_few_at_once(spark):
    """However many tasks' sums are in it; and as many as go to Python at once stay small."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert rows * lm.BLOCK * 8 <= 1 << 26
    batch = pa.record_batch({"block": range(rows), "data": [bytes([i % 256]) * 40_000 for i in range(rows)]})
    tracemalloc.start()
    try:
        found = [(block, len(data), data[0]) for block, data in lm.rows_of(iter([batch, batch.slice(0, 0)]))]
        assert tracemalloc.get_traced_memory()[1] < 10_000_000
    finally:
        tracemalloc.stop()
    assert found == [(i, 40_000, i % 256) for i in range(rows)]


def test_sums_over_tasks(spark):
    """Of several blocks, the last one not full; blocks of zeros are left out on the way."""
    size = 3 * lm.BLOCK + 5

    def run(batches):
        total = np.zeros(size)
        for x in (x for b in batches for x in b.column(0).to_pylist()):
            total[x % size] += 1
            total[-1] += x
        return total

    expected = np.zeros(size)
    expected[:100] = 1
    expected[-1] = sum(range(100))
    assert (lm.summed(spark.range(0, 100, 1, 7), run, size) == expected).all()


def test_sums_are_small_and_not_sorted(spark, monkeypatch):
    """What goes to Python at once is 16 MB at most, and no sort takes its pages of memory."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert rows * lm.BLOCK * 8 <= 1 << 24
    df = spark.range(0, 100, 1, 7)

    def sort(*_):
        raise AssertionError("sorted")

    for name in ("sortWithinPartitions", "sort", "orderBy"):
        monkeypatch.setattr(type(df), name, sort)
    size = lm.BLOCK * (lm.ROWS_OUT + 1) + 3  # more rows than leave a task at once
    found = lm.summed(df, lambda batches: np.full(size, sum(b.num_rows for b in batches)), size)
    assert (found == 100).all()


def test_every_word_is_masked_once(spark, sample):
    for chunk in read(lm._encoded(documents(spark, sample))):
        chosen = np.concatenate([chunk.masked(i, 3) for i in range(3)])
        assert sorted(chosen.tolist()) == list(range(len(chunk.words)))


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 1 << 18)
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (1, 4, 16):
        rows = lm.score_documents(docs.repartition(parts, F.rand(parts))).collect()
        found.append({r.doc_id: (r.n_words, r.mean_log_prob or 0.0) for r in rows})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for doc_id, (n, mean) in found[0].items():
            assert other[doc_id][0] == n and abs(other[doc_id][1] - mean) < 0.01


def test_training_helps_on_held_out_documents(spark):
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text")
    seen = lm._encoded(docs.where("doc_id % 4 > 0"))
    start, buckets = lm.initial_model(seen)
    model = lm.train_model(seen)
    held = read(lm._encoded(docs.where("doc_id % 4 = 0")))
    n = sum(len(c.words) for c in held)
    shares = sum(np.log(buckets.share[c.buckets[c.words]]).sum() for c in held) / n
    before, after = (sum(m.log_probs(c, c.windows()).sum() for c in held) / n for m in (start, model))
    assert after > max(shares, before) + 0.4


def test_prose_scores_above_shuffled_words(spark):
    rng = random.Random(0)
    order = [f"w{i}" for i in range(40)]
    texts = [" ".join(order[(s + i) % 40] for i in range(60)) for s in rng.choices(range(40), k=3000)]
    shuffled = [" ".join(rng.sample(t.split(), 60)) for t in texts[:50]]
    rows = list(enumerate(texts + shuffled))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {r.doc_id: r.log_prob for r in lm.score_documents(docs, rounds=4).collect()}
    good, bad = (np.mean([found[i] for i in x]) for x in (range(50), range(3000, 3050)))
    assert good > bad + 20


def test_odd_documents(odd_docs, no_docs):
    docs, rows = odd_docs
    found = lm.score_documents(docs, rounds=1).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in found) == sorted((d or 0, len((t or "").encode().split())) for d, t in rows)
    for r in found:
        assert (r.log_prob < 0 and abs(r.mean_log_prob * r.n_words - r.log_prob) < 1e-6) if r.n_words else (r.log_prob, r.mean_log_prob) == (0.0, None)
    repeated = [r.log_prob for r in found if r.doc_id == 1]
    assert len(repeated) == 2 and repeated[0] == pytest.approx(repeated[1])
    assert lm.score_documents(no_docs).collect() == []
