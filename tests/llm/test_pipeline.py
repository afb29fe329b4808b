from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import pyarrow.parquet as pq

import __spark_entry__ as entry
from streamlookup.llm import quality_classifier, queries

from .conftest import SF_DIR
from .test_decontamination import plain_matches
from .test_near_dedup import brute_force
from .test_packing import best_fit_decreasing, check_packed
from .test_secrets import plain_spans


def test_queries_are_registered():
    registered = entry.queries()
    assert {*queries.QUERIES, "pipeline"} <= set(registered)
    assert [sum(name.startswith(f"op{i}_") for name in registered) for i in range(1, 14)] == [1] * 13
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_dedup", "decontamination", "secret_scan", "best_fit_packing",
    ]


def test_every_stage_by_brute_force(spark, sample):
    stages = dict(corpus_pipeline.STAGES)
    read = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")

    def rows_of(df):
        assert df.schema == read.schema
        return [r.asDict() for r in df.collect()]

    # Which documents the classifier keeps is its own test's matter; that the stage
    # does what it says is not.
    kept = {r.doc_id for r in quality_classifier.judge_quality(read, labels).where("kept").collect()}
    docs = rows_of(stages["quality_classifier"](spark, read, SF_DIR))
    assert sorted(r["doc_id"] for r in docs) == sorted(r["doc_id"] for r in sample if r["doc_id"] in kept)
    assert len(docs) < len(sample)

    frame = spark.createDataFrame(docs, read.schema)
    pairs = [(r["doc_id"], r["text"]) for r in docs]
    stay = {d for d, _, _, own in brute_force(pairs, 80) if own}
    docs = rows_of(stages["near_dedup"](spark, frame, SF_DIR))
    assert sorted(r["doc_id"] for r in docs) == sorted(stay) and len(stay) < len(pairs)

    frame = spark.createDataFrame(docs, read.schema)
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    leaks = {d for d, *_ in plain_matches([(r["doc_id"], r["text"]) for r in docs], items, 5, 0.6)}
    clean = rows_of(stages["decontamination"](spark, frame, SF_DIR))
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in docs if r["doc_id"] not in leaks)

    frame = spark.createDataFrame(clean, read.schema)
    redacted = rows_of(stages["secret_scan"](spark, frame, SF_DIR))
    before = {r["doc_id"]: r["text"] for r in clean}
    assert sorted(before) == sorted(r["doc_id"] for r in redacted)
    for r in redacted:
        assert not plain_spans(r["text"])
        assert (r["text"] == before[r["doc_id"]]) == (not plain_spans(before[r["doc_id"]]))

    frame = spark.createDataFrame(redacted, read.schema)
    rows = stages["best_fit_packing"](spark, frame, SF_DIR).collect()
    sequences = check_packed(rows, [(r["doc_id"], r["text"]) for r in redacted], 4096)
    assert len(sequences) == len(best_fit_decreasing([r.length for r in rows], 4096))

    # The whole run gives the same pieces; sequences may be numbered otherwise.
    whole = entry.queries()["pipeline"](spark, SF_DIR).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, whole)) == Counter(map(key, rows))
    fill = defaultdict(int)
    for r in whole:
        fill[r.sequence_id] += r.length
    assert len(fill) == len(sequences)


def test_stages_of_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs[0].withColumn("lang", odd_docs[0]["lang"].cast("string")), no_docs):
        found = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, found, SF_DIR)
            assert found.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, found, SF_DIR).collect()
