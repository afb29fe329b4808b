from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from streamlookup.llm import quality_classifier as qc

from .conftest import DOCS, SF_DIR

LARGER = SF_DIR.replace("0.001", "0.01")


def test_features_need_no_words():
    for text in (None, "", " \n\t"):
        assert qc.features(text) == [0.0] * len(qc.FEATURES)
    assert len(qc.features("one")) == len(qc.FEATURES) and all(map(np.isfinite, qc.features("|" * 99)))


def test_fit_is_the_penalised_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(qc.FEATURES) + 1))
    good = (x[:, 0] - x[:, 3] + rng.normal(size=300) > 0).astype(float)
    fitted = qc.fit_evidence(x, good)
    design = qc._design((x - fitted.mean) / fitted.scale)

    def loss(w):
        z = design @ w
        return (np.logaddexp(0, z) - good * z).sum() + 0.5 * qc.PENALTY * (w[:-1] ** 2).sum()

    best = loss(fitted.weights)
    assert all(loss(fitted.weights + 0.01 * rng.normal(size=len(fitted.weights))) > best for _ in range(50))


@pytest.mark.parametrize("good", [[], [1.0, 1.0], [0.0]])
def test_one_kind_of_label_is_no_evidence(good):
    fitted = qc.fit_evidence(np.zeros((len(good), len(qc.FEATURES) + 1)), np.array(good))
    assert fitted.ratio(["some text", None]).tolist() == [0.0, 0.0]


def plain_priors(rows):
    """Posterior means per path, with plain loops."""
    share = np.mean([p for *_, p in rows])

    def strength(sites):
        between = sum(n * ((g / n - parent) ** 2 - parent * (1 - parent) / n) for n, g, parent in sites)
        within = sum(n * parent * (1 - parent) for n, _, parent in sites)
        return qc.STRENGTH[1] if between <= 0 else float(np.clip(within / between - 1, *qc.STRENGTH))

    def totals(key):
        found = {}
        for row in rows:
            n, g = found.get(key(row), (0, 0.0))
            found[key(row)] = (n + 1, g + row[2])
        return found

    hosts, paths = totals(lambda r: r[0]), totals(lambda r: r[:2])
    k = strength([(n, g, share) for n, g in hosts.values()])
    host_prior = {h: (g + k * share) / (n + k) for h, (n, g) in hosts.items()}
    k = strength([(n, g, host_prior[h]) for (h, _), (n, g) in paths.items()])
    return {(h, p): (g + k * host_prior[h]) / (n + k) for (h, p), (n, g) in paths.items()}


def test_priors(spark):
    rng = random.Random(6)
    rows = []
    for h in range(12):
        level = rng.random()
        for p in range(rng.randint(1, 5)):
            bent = min(max(level + rng.uniform(-0.2, 0.2), 0.02), 0.98)
            rows += [(f"h{h}" if h else None, f"p{p}" if p else None, float(rng.random() < bent)) for _ in range(rng.choice([1, 3, 200]))]
    found = qc.site_priors(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {(r.host, r.path): r.prior for r in found.collect()}
    expected = plain_priors(rows)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in expected)
    # A site of one document stays near its host.
    alone = [k for k in got if sum(r[:2] == k for r in rows) == 1]
    assert alone and all(0 < got[k] < 1 for k in alone)


def plain_words(text):
    return {xxhash.xxh3_64_intdigest(w) >> 48 for w in (text or "").encode().lower().split()}


def plain_odds(docs):
    """Log odds per bucket of labelled (text, quality), by loops."""
    totals, counts = [0.0, 0.0], {}
    for text, good in docs:
        totals = [totals[0] + 1 - good, totals[1] + good]
        for b in plain_words(text):
            bad_n, good_n = counts.get(b, (0.0, 0.0))
            counts[b] = bad_n + 1 - good, good_n + good
    return {b: np.log((g + 1) / (totals[1] + 2)) - np.log((n + 1) / (totals[0] + 2)) for b, (n, g) in counts.items()}


def plain_score(odds, text):
    words = plain_words(text)
    return sum(odds.get(b, 0.0) for b in words) / len(words) if words else 0.0


def test_whole_query_by_loops(spark, sample):
    """Every probability of ``judge_quality`` again: the words' odds, the fit, sums of sites without the document."""
    labels = {r["doc_id"]: float(r["quality"]) for r in pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()}
    texts = {r["doc_id"]: r["text"] for r in sample}
    ids = sorted(set(labels) & set(texts))
    frame = spark.createDataFrame([(d,) for d in ids], "doc_id long")
    half = {r.doc_id: r.half for r in frame.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2) AS half").collect()}
    halves = [plain_odds([(texts[d], labels[d]) for d in ids if half[d] == h]) for h in range(2)]
    design = np.array([[*qc.features(texts[d]), plain_score(halves[1 - half[d]], texts[d])] for d in ids])
    fitted = qc.fit_evidence(design, np.array([labels[d] for d in ids]))
    odds = plain_odds([(texts[d], labels[d]) for d in ids])
    rows = []
    for r in sample:
        found = np.array([[*qc.features(r["text"]), plain_score(odds, r["text"])]])
        ratio = float(np.clip(fitted.log_odds(found), -np.log(1 / qc.LEAST_P - 1), np.log(1 / qc.LEAST_P - 1))[0]) - fitted.base
        rows.append((r["source"], r["lang"], 1 / (1 + np.exp(-ratio - fitted.base)), ratio, r["doc_id"]))
    share = np.mean([r[2] for r in rows])

    def sums(key):
        found = {}
        for r in rows:
            n, g = found.get(key(r), (0, 0.0))
            found[key(r)] = (n + 1, g + r[2])
        return found

    def strength(sites):
        between = sum(n * ((g / n - parent) ** 2 - parent * (1 - parent) / n) for n, g, parent in sites)
        within = sum(n * parent * (1 - parent) for n, _, parent in sites)
        return qc.STRENGTH[1] if between <= 0 else float(np.clip(within / between - 1, *qc.STRENGTH))

    hosts, paths = sums(lambda r: r[0]), sums(lambda r: r[:2])
    of_hosts = strength([(n, g, share) for n, g in hosts.values()])
    host_prior = {h: (g + of_hosts * share) / (n + of_hosts) for h, (n, g) in hosts.items()}
    of_paths = strength([(n, g, host_prior[h]) for (h, _), (n, g) in paths.items()])
    want = {}
    for host, path, p, ratio, doc_id in rows:
        (n, g), (m, f) = hosts[host], paths[host, path]
        above = (g - p + of_hosts * share) / (n - 1 + of_hosts)
        prior = (f - p + of_paths * above) / (m - 1 + of_paths)
        prior = min(max(prior, qc.LEAST_PRIOR), 1 - qc.LEAST_PRIOR)
        want[doc_id] = 1 / (1 + np.exp(-ratio) * (1 - prior) / prior)
    docs, labelled = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    judged = qc.judge_quality(docs, labelled).collect()
    assert len(judged) == len(want) and all(abs(r.p_quality - want[r.doc_id]) < 1e-7 for r in judged)
    assert all(r.kept == (r.p_quality >= qc.ACCEPTED) for r in judged)


def test_words_tell_prose_from_prose(spark):
    """Texts alike in every share: only their words are good or bad."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        good = i % 2
        own = [f"{'ab'[good]}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)]
        both = [f"c{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(60)]
        words = own + both
        rng.shuffle(words)
        rows.append((i, " ".join(words), "one", "x", good))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, quality int")
    judged = qc.judge_quality(frame.drop("quality"), frame.where("doc_id < 300").select("doc_id", "quality")).collect()
    held = [r.kept == bool(r.doc_id % 2) for r in judged if r.doc_id >= 300]
    assert np.mean(held) > 0.97


def test_a_site_of_one_document_is_judged_by_its_host(spark):
    rows = [("h", "alone", 0.99), *[("h", "p", 0.1)] * 50, ("other", "alone", 0.99)]
    frame = spark.createDataFrame([(h, p, float(np.log(x / (1 - x)))) for h, p, x in rows], "host string, path string, ratio double")
    found, _ = qc._posterior(frame, 0.0)
    alone = {r.host: r.prior for r in found.where("path = 'alone'").collect()}
    # Without the document itself nothing of its path is left but what the host says.
    assert alone["h"] < 0.2


def test_held_out_documents(spark):
    """Fitted on half the labels, judged on the other half."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    known = [(r["doc_id"], r["quality"]) for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()]
    judged = {r.doc_id: r for r in qc.judge_quality(docs, labels.where("doc_id % 2 = 0")).collect()}
    assert len(judged) == docs.count()
    held = [(judged[d].kept, bool(q)) for d, q in known if d % 2]
    good = [kept for kept, q in held if q]
    bad = [kept for kept, q in held if not q]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1
    for r in judged.values():
        odds = r.evidence + np.log(r.site_prior / (1 - r.site_prior))
        assert abs(r.p_quality - 1 / (1 + np.exp(-odds))) < 1e-9 and r.kept == (r.p_quality >= qc.ACCEPTED)


def test_accepted_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    judged = qc.judge_quality(docs, labels).where("kept").select("doc_id")
    kept = qc.accepted(docs, labels)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.collect())


def test_odd_documents(spark, odd_docs):
    docs, rows = odd_docs
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (5, 1, 0), (None, 1, 0), (7, None, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    judged = qc.judge_quality(docs, labels).collect()
    assert sorted(r.doc_id or 0 for r in judged) == sorted(d or 0 for d, _ in rows)
    assert all(0 <= r.p_quality <= 1 for r in judged)
    assert qc.accepted(docs, labels).schema == docs.schema
    by_host = qc.judge_quality(docs, labels, host=F.col("bucket"), path=F.lit(None)).collect()
    assert {(r.host, r.path) for r in by_host} == {("b", None)}


def test_without_documents_or_labels(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert qc.judge_quality(no_docs, labels).collect() == []
    assert qc.accepted(no_docs, labels).collect() == []
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    assert [r.kept for r in qc.judge_quality(docs, labels).collect()] == [True]
    assert qc.accepted(odd_docs[0], labels).count() == len(odd_docs[1])
