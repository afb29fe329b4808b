from __future__ import annotations

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from streamlookup.llm import licenses, quality_rules
from streamlookup.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SF_DIR

WHITE = " \t\n\x0b\x0c\r"


def plain_metrics(text):
    text = text or ""
    marked = "".join(" " if c in WHITE else c for c in text)
    words = [w for w in marked.split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return {
        "n_words": len(words), "n_distinct": len(set(words)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
    }


def plain_kept(text):
    m, text = plain_metrics(text), text or ""
    n = m["n_words"]
    if n < 50 or 100 * m["n_repeat_words"] > 50 * n:
        return True, False
    capitals = sum(c.isupper() for c in text)
    bad = (
        10 * m["n_symbols"] > 3 * n or 2 * m["n_dup_lines"] > m["n_lines"] or 10 * m["n_distinct"] < n
        or not 2 * n <= m["word_chars"] <= 20 * n or 5 * text.count("!") > n or 2 * capitals > m["word_chars"]
    )
    return False, not bad


def rows_of(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in quality_rules.judge_documents(frame).collect()}


TEXTS = [
    None, "", " \n\t", "a a a", "a a a a", "a b c a b c", "a b c d a b c", "x y z x y z x y z q", "a\x85b c\xa0d",
    "one\none\n \none\ntwo", "é😀 é😀 é😀 é😀", " a  b ", "A#*$%&|<>b", "w " * 60, "same line here\n" * 30,
    "WORD " * 3 + " ".join(f"W{i}ORD" for i in range(60)), " ".join(f"word{i}!" for i in range(60)),
    " ".join(f"word{i} |" for i in range(60)), " ".join("w" * 30 + str(i) for i in range(60)), " ".join(f"fine{i}" for i in range(60)),
]


def test_metrics_and_verdicts(spark, sample):
    texts = TEXTS + [r["text"] for r in sample if len(r["text"]) < 6000]
    found = rows_of(spark, list(enumerate(texts)))
    for i, text in enumerate(texts):
        want = plain_metrics(text)
        assert {m: found[i][m] for m in quality_rules.METRICS} == {m: want[m] for m in quality_rules.METRICS}, text
        assert (found[i].base_failed, found[i].kept) == plain_kept(text), text
        assert found[i].kept == (found[i].rejected_by is None)


def test_odd_documents(odd_docs, no_docs):
    docs, rows = odd_docs
    found = quality_rules.judge_documents(docs).collect()
    assert sorted(r.doc_id or 0 for r in found) == sorted(d or 0 for d, _ in rows)
    long_row = next(r for r in found if r.doc_id == 5)
    assert long_row.n_words == 36_000 == long_row.n_repeat_words and long_row.base_failed
    assert quality_rules.judge_documents(no_docs).collect() == []


def test_order_of_rules(spark):
    rules = [quality_rules.Rule(n, F.col("id") < k) for n, k in (("few", 10), ("many", 900), ("none", 0))]
    estimates = [quality_rules.Estimate("few", 0.1, 0.01), quality_rules.Estimate("many", 0.2, 0.9), quality_rules.Estimate("none", 0.01, 0.0)]
    ordered = quality_rules.by_gain(rules, estimates)
    assert [r.name for r in ordered] == ["many", "few", "none"]
    rows = spark.range(1000)
    counts = {r[0]: r[1] for r in rows.groupBy(quality_rules.cascade(ordered).alias("by")).count().collect()}
    assert counts == {"many": 900, None: 100}
    found = quality_rules.estimate(rows.limit(500), rules)
    assert [(e.name, e.rejected) for e in found] == [("few", 0.02), ("many", 1.0), ("none", 0.0)]
    assert quality_rules.estimate(spark.range(0), rules)[0].rejected == 0


def test_costly_rules_come_later(spark, sample):
    """Of two rules that reject the same rows the one that works on the text comes second, whatever the order given."""
    slow = F.col("text")
    for _ in range(40):
        slow = F.sha2(F.concat(slow, F.col("text")), 512)
    rules = [
        quality_rules.Rule("costly", (F.col("n_words") > 200) & (F.length(slow) > 0)),
        quality_rules.Rule("cheap", F.col("n_words") > 200),
        quality_rules.Rule("rare", F.col("n_words") > 10**9),
    ]
    docs = spark.createDataFrame([(r["doc_id"], r["text"] * 5) for r in sample], "doc_id long, text string")
    measured = quality_rules.estimate(quality_rules.with_metrics(docs), rules)
    costly, cheap, rare = measured
    assert costly.seconds > cheap.seconds and costly.rejected == cheap.rejected > 0 == rare.rejected
    assert [r.name for r in quality_rules.by_gain(rules, measured)] == ["cheap", "costly", "rare"]
    found = quality_rules.judge_documents(docs, rules).groupBy("rejected_by").count().collect()
    assert "costly" not in {r["rejected_by"] for r in found}


def test_all_counts_are_reported(spark):
    """A document's row has its distinct words and its lines, and the SQL reports them too."""
    found = rows_of(spark, list(enumerate(TEXTS)))
    for i, text in enumerate(TEXTS):
        assert {c: found[i][c] for c in quality_rules.COUNTS} == plain_metrics(text), text
    for count in quality_rules.COUNTS:
        assert f"{count}," in ORACLE_SQL["op10_quality_rules"].split("FROM counted)")[-1]


def test_rules_have_their_own_metrics(spark):
    """What only a rule needs is in no row's counts, and the sample does not hang on partitions."""
    assert quality_rules.METRICS == ("n_words", "n_repeat_words", "n_dup_lines", "word_chars", "n_symbols")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9000)], "doc_id long, text string")
    place = quality_rules.is_among(quality_rules.place_of("doc_id", "text"), quality_rules.SAMPLE_ROWS, 9000)
    samples = [sorted(r.doc_id for r in d.where(place).collect()) for d in (docs, docs.repartition(7))]
    assert samples[0] == samples[1] and 1500 < len(samples[0]) < 2500


def test_later_rules_are_not_worked_out(spark):
    fails = quality_rules.Rule("boom", F.raise_error(F.lit("worked out")).cast("boolean"))
    rules = [quality_rules.Rule("first", F.col("id") >= 0), fails]
    assert spark.range(5).select(quality_rules.cascade(rules).alias("by")).distinct().collect()[0].by == "first"


@pytest.mark.parametrize("name", ["op4_license_scan", "op10_quality_rules"])
def test_native_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, name):
    got = compare.spark_bag(QUERIES[name](spark, SF_DIR))
    assert got == compare.duck_bag(compare.connect(SF_DIR), ORACLE_SQL[name])


MIT = f"{licenses.SENTENCES[4]}:\n\n{licenses.SENTENCES[5]}.\n"
LICENSED = [
    ("Text.\nReleased under the MIT License.", "MIT", "2"),
    ("words | words\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0", "6"),
    (f'{licenses.SENTENCES[7]};\n{licenses.SENTENCES[8]}.', "Apache-2.0", "7 8"),
    ("  this WORK is licensed under the GNU\nGeneral Public License,   version 3. x", "GPL-3.0", "9"),
    (MIT, "MIT", "4 5"),
    (MIT.replace(" copy", "\ncopy"), "MIT", "4 5"),
    ("All rights reserved. Released under the MIT License.", "MIT", "1 2"),
    ("Licensed under CC BY-NC 4.0. Released under the MIT License", "CC-BY-NC-4.0", "17 2"),
    (f"{licenses.SENTENCES[14]}. {licenses.SENTENCES[13]}:", "BSD-2-Clause", "14 13"),
    (f"{licenses.SENTENCES[13]}: {licenses.SENTENCES[14]}.", "BSD-3-Clause", "13 14"),
    (f"This program is free software: {licenses.SENTENCES[10]}.", "GPL-3.0-or-later", "10"),
    ("Not released under the MIT License.", None, ""),
    ("Released under the MIT License today.", None, ""),
    ("Redistribution is a word, permission too", None, ""),
    (licenses.SENTENCES[14], None, "14"),
    ("All rights\nreserved.", "All-rights-reserved", "1"),
    ("All  rights   reserved", "All-rights-reserved", "1"),
    ("# This is free and unencumbered software released into the public\n# domain.", "Unlicense", "21"),
    (None, None, ""),
    ("", None, ""),
]


def gnu(kind, version, stop):
    return (
        f"// This library is free software{stop.replace(",", ":")} you can redistribute it and/or\n// modify it under the terms of the GNU {kind}General\n"
        f"// Public License as published by the Free Software Foundation{stop} either\n// version {version} of the License, or (at your option) any later version.\n"
    )


USUAL = [
    (gnu("", "2", ";"), "GPL-2.0-or-later", False),
    (gnu("", "2", ","), "GPL-2.0-or-later", False),
    (gnu("", "3", ";"), "GPL-3.0-or-later", False),
    (gnu("", "3", ","), "GPL-3.0-or-later", False),
    (gnu("Library ", "2", ";"), "LGPL-2.0-or-later", False),
    (gnu("Lesser ", "2.1", ";"), "LGPL-2.1-or-later", False),
    (gnu("Lesser ", "3", ";"), "LGPL-3.0-or-later", False),
    (gnu("Affero ", "3", ";"), "AGPL-3.0-or-later", False),
    (gnu("Affero ", "3", ","), "AGPL-3.0-or-later", False),
    ("either version 2 of the License, or (at your option) any later version.", None, None),
    ("This project is licensed under the MIT License.", "MIT", True),
    ("This project is licensed under the MIT License - see the [LICENSE.md](LICENSE.md) file for details", "MIT", True),
    ("Licensed under the GNU Affero General Public License v3.0", "AGPL-3.0", False),
    (licenses.SENTENCES[36] + ".", "EPL-2.0", False),
    ("# SPDX-License-Identifier: Apache-2.0\nimport os", "Apache-2.0", True),
    ("/* SPDX-License-Identifier: LGPL-2.1-or-later */", "LGPL-2.1-or-later", False),
    ("MIT\nIsc", None, None),
    ("SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later", False),
    ("// SPDX-License-Identifier: LGPL-2.1+ WITH some-exception", "LGPL-2.1-or-later", False),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0", True),
    ("# SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)", "GPL-2.0", False),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n", "Apache-2.0", True),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0", False),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0", False),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3.0", False),
    ("Version 3, 29 June 2007", None, None),
    ("The MIT License (MIT)\n\nCopyright (c) 2020 Somebody", "MIT", True),
    ("Licensed under the MIT License. Also licensed under the GNU General Public License, version 3.", "GPL-3.0", False),
]

SEVERAL = [
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0 MIT"),
    ("Licensed under the MIT License. Also licensed under the GNU General Public License, version 3.", "GPL-3.0 MIT"),
    (f"{licenses.SENTENCES[13]}: {licenses.SENTENCES[14]}.", "BSD-3-Clause"),
    (f"{licenses.SENTENCES[13]}.", "BSD-2-Clause"),
    ("All rights reserved. Released under the MIT License.", "MIT All-rights-reserved"),
    ("nothing", None),
]


def test_all_licences_of_a_text(spark):
    rows = [(i, t) for i, (t, _) in enumerate(SEVERAL)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.licenses for r in sorted(found, key=lambda r: r.doc_id)] == [names for _, names in SEVERAL]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    named = connection.execute(f"SELECT licenses FROM ({ORACLE_SQL['op4_license_scan']}) ORDER BY doc_id").fetchall()
    assert [n for (n,) in named] == [names for _, names in SEVERAL]


def test_usual_notices(spark):
    rows = [(i, t) for i, (t, *_) in enumerate(USUAL)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(frame).collect()}
    assert [(t, found[i].license, found[i].permissive) for i, t in rows] == USUAL
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows + [(100 + i, t) for i, (t, *_) in enumerate(LICENSED)])
    named = dict(connection.execute(f"SELECT doc_id, license FROM ({ORACLE_SQL['op4_license_scan']})").fetchall())
    assert named == {i: row[1] for at, table in ((0, USUAL), (100, LICENSED)) for i, row in enumerate(table, at)}


def test_licenses(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, (t, *_) in enumerate(LICENSED)], "doc_id long, text string, license string")
    found = {r.doc_id: (r.license, r.sentences) for r in licenses.scan_licenses(frame).collect()}
    assert found == {i: tuple(rest) for i, (_, *rest) in enumerate(LICENSED)}


def test_triggers_cannot_be_broken():
    assert not [t for t in licenses.TRIGGERS if licenses.normal(t) != t or " " in t]


def test_known_sentences_can_be_found():
    for sentence in licenses.SENTENCES.values():
        assert any(t in sentence.lower() for t in licenses.TRIGGERS)
    assert len({licenses.normal(s) for s in licenses.SENTENCES.values()}) == len(licenses.SENTENCES)
    assert {i for rule in licenses.RULES for i in rule.sentences} <= set(licenses.SENTENCES)


def test_licenses_of_odd_documents(odd_docs, no_docs):
    docs, rows = odd_docs
    found = licenses.scan_licenses(docs).collect()
    assert len(found) == len(rows) and all(r.license is None for r in found)
    assert licenses.scan_licenses(no_docs).collect() == []
