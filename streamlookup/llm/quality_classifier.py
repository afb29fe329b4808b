"""Quality of documents by hierarchical empirical Bayes.

A classifier of the text gives each document's own evidence. Sites give the prior:
the share of good documents of all, of a host and of a path on it, each level shrunk
towards the one above by as much as sites at that level are found to be alike. A
site with few documents thus has nearly the prior of its parent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_slices
from streamlookup.llm.sampling import is_among, place_of
from streamlookup.llm.words import hashes_of
from streamlookup.operators.sizing import fits
from streamlookup.sources.shared import written

# Labelled documents that the classifier is fitted on: a bounded sample, those
# with the smallest hash of their id.
SAMPLE_LABELS = 6_000

# Weight of the penalty on the classifier's weights, and Newton steps of the fit.
PENALTY = 1.0
STEPS = 25

# Bounds of a classifier's certainty and of a site's prior, and the strength of
# priors, in documents.
LEAST_P = 1e-6
LEAST_PRIOR = 0.05
STRENGTH = (1.0, 1e4)

ACCEPTED = 0.5

FEATURES = (
    "log_words", "capital_words", "symbols", "bars", "exclamations", "same_as_before", "not_distinct",
    "most_common", "repeated_lines", "word_length", "long_words", "digits",
)

# Words count by the bucket of their hash; a bucket seen in no labelled document says nothing.
WORD_BUCKETS = 1 << 16

_SYMBOLS = "#*$%&@~^=<>"
_DIGITS = re.compile(r"[0-9]+")


def features(text: str | None) -> list[float]:
    """Shares that tell prose from junk, whatever the language. All 0 without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    symbols = sum(map(text.count, _SYMBOLS))
    return [
        np.log1p(n),
        sum(map(str.isupper, words)) / n,
        min(symbols / n, 3.0),
        min(text.count("|") / n, 1.0),
        min(text.count("!") / n, 2.0),
        sum(a == b for a, b in zip(words, islice(words, 1, None))) / n,
        1 - len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        min((len(text) - n) / n, 30.0) / 10,
        sum(len(w) > 30 for w in words) / n,
        min(sum(map(len, _DIGITS.findall(text))) / len(text), 1.0),
    ]


def word_buckets(text: str | None) -> np.ndarray:
    """The buckets of a text's words, each once; A-Z count as lower case."""
    words = set((text or "").encode().lower().split())
    return np.unique(hashes_of(list(words)) >> np.uint64(48)).astype(np.int64)


def word_odds(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Per bucket the log odds between the shares of good and of bad documents that have it, from
    counts of documents (a row for bad, one for good)."""
    odds = np.log(counts[1] + 1) - np.log(totals[1] + 2) - np.log(counts[0] + 1) + np.log(totals[0] + 2)
    return np.where(counts.sum(axis=0) > 0, odds, 0.0)


def word_score(odds: np.ndarray, buckets: np.ndarray) -> float:
    """The mean odds of a text's words; 0 without any."""
    return float(odds[buckets].mean()) if len(buckets) else 0.0


@dataclass(frozen=True)
class Evidence:
    """A logistic classifier over the features and the words' score, and its sample's log odds of good."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant
    base: float
    words: np.ndarray

    def log_odds(self, found: np.ndarray) -> np.ndarray:
        return _design((found - self.mean) / self.scale) @ self.weights

    def described(self, text: str | None) -> list[float]:
        return [*features(text), word_score(self.words, word_buckets(text))]

    def ratio(self, texts: list) -> np.ndarray:
        """Log likelihood ratio of good against bad."""
        if not len(texts):
            return np.empty(0)
        bound = float(np.log((1 - LEAST_P) / LEAST_P))
        odds = self.log_odds(np.array([self.described(text) for text in texts]))
        return np.clip(odds, -bound, bound) - self.base


def _design(z: np.ndarray) -> np.ndarray:
    """Features, their squares and a constant."""
    z = np.clip(z, -8, 8)
    return np.hstack([z, z * z, np.ones((len(z), 1))])


def _log_odds(p):
    return np.log(p) - np.log1p(-p)


def fit_evidence(found: np.ndarray, good: np.ndarray, words: np.ndarray | None = None) -> Evidence:
    """Penalised logistic regression by Newton's method. Without rows of both kinds
    there is no evidence: every ratio is 0. ``found`` has the features and the words' score."""
    n = len(FEATURES) + 1
    words = np.zeros(WORD_BUCKETS) if words is None else words
    if not len(good) or good.min() == good.max():
        return Evidence(np.zeros(n), np.ones(n), np.zeros(2 * n + 1), 0.0, words)
    share = good.mean()
    mean, scale = found.mean(axis=0), found.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = _design((found - mean) / scale)
    w = np.zeros(x.shape[1])
    w[-1] = _log_odds(share)
    penalty = np.full(len(w), PENALTY)
    penalty[-1] = 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (good - p) - penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(mean, scale, w, float(_log_odds(share)), words)


def train_evidence(docs: DataFrame, labels: DataFrame, sample_labels: int = SAMPLE_LABELS) -> Evidence:
    """Fit on a bounded sample of labelled documents. A document with several labels
    has their mean; labels that are NULL or have no document count for nothing.

    The odds of words come from counts per bucket in two halves of the sample. A document of the sample
    is described by those of the other half, as its own words would speak too well of it; later ones
    by both. To the driver come the counts, a number that does not depend on the texts, and a row of features a document.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    place = place_of("doc_id")
    known = known.where(is_among(place, sample_labels, known.count()))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    chosen = known.orderBy(place, "doc_id").limit(sample_labels).collect()
    none = np.empty((0, len(FEATURES) + 1))
    if not chosen:
        return fit_evidence(none, np.empty(0))
    chosen = F.broadcast(spark.createDataFrame(chosen, known.schema))
    # A document that is repeated counts once.
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("text").alias("text")
    )
    sample = written(sample.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")), "labelled")

    def count(_: list, quality: list, texts: list, halves: list) -> dict:
        total = np.zeros((2, 2, WORD_BUCKETS + 1))
        for good, text, half in zip(quality, texts, halves):
            at = np.append(word_buckets(text), WORD_BUCKETS)  # the last place counts documents
            total[half, 0, at] += 1 - good
            total[half, 1, at] += good
        half, kind, bucket = np.nonzero(total)
        return {"half": half.tolist(), "kind": kind.tolist(), "bucket": bucket.tolist(), "n": total[half, kind, bucket].tolist()}

    counted = map_slices(sample, count, "half int, kind int, bucket int, n double")
    rows = counted.groupBy("half", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, 2, WORD_BUCKETS + 1))
    counts[rows["half"], rows["kind"], rows["bucket"]] = rows["n"]

    def odds_of(table: np.ndarray) -> np.ndarray:
        return word_odds(table[:, :-1], table[:, -1])

    other_half = [odds_of(counts[1]), odds_of(counts[0])]

    def describe(ids: list, quality: list, texts: list, halves: list) -> dict:
        found = [[*features(t), word_score(other_half[h], word_buckets(t))] for t, h in zip(texts, halves)]
        return {"doc_id": ids, "quality": quality, "found": found}

    found = map_slices(sample, describe, "doc_id long, quality double, found array<double>").collect()
    found.sort(key=lambda r: r["doc_id"])
    design = np.array([r["found"] for r in found]).reshape(-1, none.shape[1])
    return fit_evidence(design, np.array([r["quality"] for r in found]), odds_of(counts.sum(axis=0)))


def _strength(rows: DataFrame, parent: Column) -> float:
    """How many documents a parent's share is worth, by the method of moments.

    ``rows`` are sites with ``n`` documents of which ``good`` are expected to be good.
    What their shares vary beyond chance is the variance between sites.
    """
    share, n = F.col("good") / F.col("n"), F.col("n")
    chance = parent * (1 - parent) / n
    row = rows.agg(
        F.sum(n * ((share - parent) ** 2 - chance)).alias("between"),
        F.sum(n * parent * (1 - parent)).alias("within"),
    ).first()
    if not row["within"] or row["between"] is None or row["between"] <= 0:
        return STRENGTH[1]
    return float(np.clip(row["within"] / row["between"] - 1, *STRENGTH))


def site_priors(documents: DataFrame) -> DataFrame:
    """Prior share of good documents per ``host`` and ``path``, from ``p`` of each, with the sums it is made of.

    Sums per path, then per host and over all: each from the level below, so a host
    with a third of all documents is no more work than another. Three rows of sums
    come to the driver.
    """
    paths = written(
        documents.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = total["good"] / total["n"] if total["n"] else 0.5

    def shrunk(parent: Column, strength: float) -> Column:
        return (F.col("good") + strength * parent) / (F.col("n") + strength)

    overall = F.lit(float(share))
    host_strength = _strength(hosts, overall)
    hosts = hosts.withColumn("host_prior", shrunk(overall, host_strength))
    hosts = hosts.select(F.col("host").alias("of_host"), "host_prior", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    strength = _strength(paths, F.col("host_prior"))
    paths = paths.withColumn("prior", shrunk(F.col("host_prior"), strength))
    return paths.withColumns({"overall": overall, "host_strength": F.lit(host_strength), "path_strength": F.lit(strength)})


def prior_without(p: Column) -> Column:
    """The prior of a document's site as the other documents make it: over ``site_priors``' columns, for a
    document that adds ``p`` to its site's sums."""
    strength = F.col("host_strength")
    host = (F.col("host_good") - p + strength * F.col("overall")) / (F.col("host_n") - 1 + strength)
    strength = F.col("path_strength")
    return (F.col("good") - p + strength * host) / (F.col("n") - 1 + strength)


def _ratio_column(evidence: Evidence) -> Column:
    @F.arrow_udf("double")
    def ratio(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(evidence.ratio(texts.to_pylist()), pa.float64())

    return ratio


def _sure(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(LEAST_PRIOR)), F.lit(1 - LEAST_PRIOR))


def _posterior(documents: DataFrame, base: float) -> tuple[DataFrame, DataFrame]:
    """The documents with ``p_quality`` and ``prior``, and the priors of their sites. A document's own
    evidence is not in the prior it is joined to, or a small site's would count twice."""
    alone = _logistic(F.col("ratio") + F.lit(base))
    priors = written(site_priors(documents.select("host", "path", alone.alias("p"))), "priors")
    sums = ["n", "good", "host_n", "host_good", "overall", "host_strength", "path_strength"]
    side = priors.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), *sums)
    if fits(side):
        side = F.broadcast(side)
    same = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    joined = documents.join(side, same, "left").withColumn("prior", prior_without(alone))
    prior = _sure(F.col("prior"))
    p = _logistic(F.col("ratio") + F.log(prior) - F.log(1 - prior))
    return joined.withColumn("p_quality", p).drop("of_host", "of_path", *sums), priors


def _logistic(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def document_site(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of a document: its ``source``, and its language there. A URL's
    host and path serve as well; NULL is a site of its own."""
    return F.col("source"), F.col("lang")


def judge_quality(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, least: float = ACCEPTED
) -> DataFrame:
    """A row per document: ``host``, ``path``, ``evidence`` (log likelihood ratio),
    ``site_prior``, ``p_quality`` and ``kept`` (``p_quality`` >= ``least``).

    ``docs`` has ``doc_id``, ``text`` and what host and path are made of, by default
    ``source`` and ``lang``; ``labels`` has ``doc_id`` and ``quality`` (0 or 1). A NULL
    text is an empty one. Without labels of both kinds no document is rejected.
    Repeated rows have a row each; an empty table gives none.
    """
    default = document_site(docs)
    evidence = train_evidence(docs, labels)
    ratio = _ratio_column(evidence)
    scored = docs.select(
        "doc_id",
        (default[0] if host is None else host).cast("string").alias("host"),
        (default[1] if path is None else path).cast("string").alias("path"),
        ratio("text").alias("ratio"),
    )
    found, _ = _posterior(written(scored, "evidence"), evidence.base)
    return found.select(
        "doc_id", "host", "path", F.col("ratio").alias("evidence"), _sure(F.col("prior")).alias("site_prior"), "p_quality",
        (F.col("p_quality") >= least).alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, least: float = ACCEPTED) -> DataFrame:
    """The documents that ``judge_quality`` keeps, with all their columns.

    The evidence is worked out twice, once for the sites' sums and once where the
    document is, which costs less than storing or joining whole texts.
    """
    evidence = train_evidence(docs, labels)
    ratio = _ratio_column(evidence)
    names = [f"c{i}" for i in range(len(docs.columns))]
    host, path = document_site(docs)
    with_site = docs.select(
        *[F.col(c).alias(n) for c, n in zip(docs.columns, names)],
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        ratio("text").alias("ratio"),
    )
    found, _ = _posterior(with_site, evidence.base)
    return found.where(F.col("p_quality") >= least).select(*names).toDF(*docs.columns)
