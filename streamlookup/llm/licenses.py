"""Licences in texts, recognised by their sentences.

Known sentences, normalised, have numbers. A text becomes the sequence of the
numbers of its known sentences; ordered rules, each a sequence of numbers, name the
licence: the first whose sentences occur in that order decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences by number, as published; where one has a stop
# inside, the part that tells it apart.
SENTENCES = {
    1: "All rights reserved",
    2: "Released under the MIT License",
    3: "Licensed under the MIT License",
    4: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    5: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    6: "Licensed under the Apache License, Version 2.0",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    8: "you may not use this file except in compliance with the License",
    9: "This work is licensed under the GNU General Public License, version 3",
    10: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    11: "either version 2 of the License, or (at your option) any later version",
    12: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    13: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    14: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    15: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    16: "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    17: "Licensed under CC BY-NC 4.0",
    18: "Licensed under CC BY 4.0",
    19: "Licensed under CC BY-SA 4.0",
    20: "This work is licensed under a Creative Commons Attribution 4.0 International License",
    21: "This is free and unencumbered software released into the public domain",
    22: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    23: "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation",
    24: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    25: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    26: "either version 2.1 of the License, or (at your option) any later version",
    27: "either version 3 of the License, or (at your option) any later version",
    28: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    29: "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    30: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    31: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    32: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    33: "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    34: "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-v10.html",
    35: "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    36: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    37: "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    38: "SPDX-License-Identifier",
}

# The names that usual notices give a licence.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3"),
    "LGPL-3.0": ("GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3"),
    "LGPL-2.1": ("GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1"),
    "GPL-3.0": ("GNU General Public License v3.0", "GNU General Public License, version 3"),
    "GPL-2.0": ("GNU General Public License v2.0", "GNU General Public License, version 2"),
    "EPL-2.0": ("Eclipse Public License 2.0",),
    "EPL-1.0": ("Eclipse Public License 1.0",),
    "MPL-2.0": ("Mozilla Public License 2.0",),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "MIT": ("MIT License", "MIT License (MIT)"),
    "ISC": ("ISC License",),
}
NOTICES = (
    "{}",
    "The {}",
    "Licensed under the {}",
    "Also licensed under the {}",
    "It is also licensed under the {}",
    "Dual licensed under the {}",
    "Dual-licensed under the {}",
    "Released under the {}",
    "This project is licensed under the {}",
    "This software is licensed under the {}",
    "This project is licensed under the {} - see the LICENSE file for details",
    "This project is licensed under the {} - see the [LICENSE](LICENSE) file for details",
    "This project is licensed under the {} - see the [LICENSE.md](LICENSE.md) file for details",
)

# The first lines of whole licence texts, in their order.
HEADS = (
    ("AGPL-3.0", ("GNU Affero General Public License", "Version 3, 19 November 2007")),
    ("LGPL-3.0", ("GNU Lesser General Public License", "Version 3, 29 June 2007")),
    ("LGPL-2.1", ("GNU Lesser General Public License", "Version 2.1, February 1999")),
    ("LGPL-2.0", ("GNU Library General Public License", "Version 2, June 1991")),
    ("GPL-3.0", ("GNU General Public License", "Version 3, 29 June 2007")),
    ("GPL-2.0", ("GNU General Public License", "Version 2, June 1991")),
    ("EPL-2.0", ("Eclipse Public License - v 2.0",)),
    ("EPL-1.0", ("Eclipse Public License - v 1.0",)),
    ("MPL-2.0", ("Mozilla Public License Version 2.0",)),
    ("Apache-2.0", ("Apache License", "Version 2.0, January 2004")),
)

# Identifiers behind the sentence SPDX, and the licence they name. A '+' behind
# a version is read as "or later", and in an expression each identifier is a sentence.
SPDX = 38
IDENTIFIERS = {
    **{gnu + end: gnu + named
       for gnu in ("AGPL-3.0", "LGPL-3.0", "LGPL-2.1", "LGPL-2.0", "GPL-3.0", "GPL-2.0")
       for end, named in (("-or-later", "-or-later"), ("-only", ""), ("", ""))},
    **{i: i for i in ("EPL-2.0", "EPL-1.0", "MPL-2.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "Apache-2.0", "BSD-3-Clause",
                      "BSD-2-Clause", "MIT", "ISC", "CC-BY-4.0", "Unlicense")},
}

PERMISSIVE = {"Apache-2.0", "BSD-3-Clause", "BSD-2-Clause", "MIT", "ISC", "CC-BY-4.0", "Unlicense"}


# A version with a plus, and what is read instead.
PLUS = r"([0-9])\+"
OR_LATER = "{} or later "


def normal(sentence: str) -> str:
    """A known sentence as the sentences of texts are normalised."""
    sentence = re.sub(PLUS, OR_LATER.format(r"\1"), sentence)
    kept = "".join(c if c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def _number(sentence: str) -> int:
    """The sentence's number; a new one if it is not known yet."""
    for i, known in SENTENCES.items():
        if normal(known) == normal(sentence):
            return i
    SENTENCES[len(SENTENCES) + 1] = sentence
    return len(SENTENCES)


@dataclass(frozen=True)
class Rule:
    """``license`` if the sentences occur in this order, others between them or not."""

    license: str
    sentences: tuple[int, ...]
    permissive: bool


def _usual_rules() -> list[Rule]:
    """A rule for each usual notice and each identifier."""
    found = [
        Rule(name, (_number(notice.format(called)),), name in PERMISSIVE)
        for name, names in NAMES.items() for called in names for notice in NOTICES
    ]
    found += [Rule(name, tuple(map(_number, lines)), name in PERMISSIVE) for name, lines in HEADS]
    found += [Rule(name, (SPDX, _number(i)), name in PERMISSIVE) for i, name in IDENTIFIERS.items()]
    return found


_USUAL = _usual_rules()

# The rules in their order; longer sequences before what they contain, and
# licences that bind before those that do not.
RULES = (
    Rule("AGPL-3.0-or-later", (32,), False),
    Rule("AGPL-3.0-or-later", (25, 27), False),
    Rule("LGPL-3.0-or-later", (31,), False),
    Rule("LGPL-3.0-or-later", (24, 27), False),
    Rule("LGPL-2.1-or-later", (30,), False),
    Rule("LGPL-2.1-or-later", (24, 26), False),
    Rule("LGPL-2.0-or-later", (29,), False),
    Rule("LGPL-2.0-or-later", (23, 11), False),
    Rule("GPL-3.0-or-later", (10, 12), False),
    Rule("GPL-3.0-or-later", (10,), False),
    Rule("GPL-3.0-or-later", (22, 27), False),
    Rule("GPL-2.0-or-later", (28,), False),
    Rule("GPL-2.0-or-later", (22, 11, 12), False),
    Rule("GPL-2.0-or-later", (22, 11), False),
    Rule("GPL-2.0", (33,), False),
    Rule("GPL-3.0", (9,), False),
    Rule("EPL-1.0", (34,), False),
    Rule("EPL-1.0", (35,), False),
    Rule("EPL-2.0", (36,), False),
    Rule("EPL-2.0", (37,), False),
    *(rule for rule in _USUAL if not rule.permissive),
    Rule("CC-BY-NC-4.0", (17,), False),
    Rule("CC-BY-SA-4.0", (19,), False),
    Rule("MPL-2.0", (16,), False),
    Rule("BSD-3-Clause", (13, 14), True),
    Rule("BSD-2-Clause", (13,), True),
    Rule("Apache-2.0", (7, 8), True),
    Rule("Apache-2.0", (7,), True),
    Rule("Apache-2.0", (6,), True),
    Rule("MIT", (4, 5), True),
    Rule("MIT", (2,), True),
    Rule("MIT", (3,), True),
    Rule("ISC", (15,), True),
    Rule("CC-BY-4.0", (18,), True),
    Rule("CC-BY-4.0", (20,), True),
    Rule("Unlicense", (21,), True),
    *(rule for rule in _USUAL if rule.permissive and rule.sentences not in {(2,), (3,), (6,)}),
    Rule("All-rights-reserved", (1,), False),
)

# Every known sentence has one of these; a text without them has no known sentence. Single
# words, as a line end or a comment sign may stand between two.
TRIGGERS = (
    "licen", "reserved", "permission", "redistribut", "warranty", "domain",
    "gpl", "epl", "mpl", "cc", "apache", "bsd", "mit", "isc", "1991", "1999", "2004", "2007",
)

# Where a sentence ends: at a full stop, semicolon, colon, question or exclamation mark
# before white space or the end; and at a line end, or else only at an empty line.
# The operators of identifiers end one too.
STOP = r"[.;:?!]+(?:\s+|$)|\s+(?:OR|AND|WITH)\s+"
BY_LINE = STOP + r"|[\r\n]+"
BY_PARAGRAPH = STOP + r"|\r?\n[ \t]*\r?\n\s*"
NOT_WORD = r"[^\p{L}\p{N}]+"


def sentence_numbers(text: Column, ends: str) -> Column:
    """The numbers of a text's known sentences, in order."""
    known = {normal(sentence): i for i, sentence in SENTENCES.items()}
    words = lambda s: F.regexp_replace(F.regexp_replace(F.lower(s), PLUS, OR_LATER.format("$1")), NOT_WORD, " ")
    plain = F.transform(F.split(text, ends), lambda s: F.trim(words(s)))
    table = F.create_map(*[F.lit(v) for pair in known.items() for v in pair])
    return F.filter(F.transform(plain, lambda s: F.try_element_at(table, s)), lambda i: i.isNotNull())


def pattern_of(rule: Rule) -> str:
    return ".*".join(f",{i}," for i in rule.sentences)


def _rule(sequence: Column, rule: Rule) -> Column:
    return sequence.rlike(pattern_of(rule))


def all_patterns() -> list[tuple[str, str, str | None]]:
    """Per licence, in the order of the rules: its name, a pattern that any of its rules matches, and one of rules of
    other licences that it is only a part of (BSD-2-Clause in BSD-3-Clause), if there are such."""
    found = []
    for name in dict.fromkeys(rule.license for rule in RULES):
        own = [rule for rule in RULES if rule.license == name]
        larger = [r for r in RULES if r.license != name and any(set(rule.sentences) < set(r.sentences) for rule in own)]
        any_of = "|".join(dict.fromkeys(map(pattern_of, own)))
        found.append((name, any_of, "|".join(dict.fromkeys(map(pattern_of, larger))) or None))
    return found


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per document: ``license`` (NULL without one), whether it is ``permissive``, ``licenses``, all that
    its sentences name, the one that binds most first, and ``sentences``, the numbers of the known
    sentences in their order.

    Sentences are read by line, and once more with lines joined, for licences whose
    sentences are broken into lines; the first reading that has a known sentence and
    matches a rule counts. ``docs`` has ``doc_id`` and ``text``; other columns are not
    read. NULL and empty texts have no licence. Repeated rows have a row each; an empty
    table gives none. Nothing is shuffled, and all is done by column expressions.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lowered = F.lower(text)
    hint = reduce(lambda a, b: a | b, [lowered.contains(t) for t in TRIGGERS])
    none = F.lit("")

    def sequence(ends: str) -> Column:
        numbers = F.transform(sentence_numbers(text, ends), lambda i: F.concat(F.lit(","), i.cast("string"), F.lit(",")))
        return F.when(F.col("hint"), F.array_join(numbers, "")).otherwise(none)

    found = docs.select("doc_id", "text").withColumn("hint", hint)
    found = found.select("doc_id", sequence(BY_LINE).alias("by_line"), sequence(BY_PARAGRAPH).alias("by_paragraph"))

    def first(sequence: Column) -> Column:
        # One flat list of cases: there are too many for one inside the other.
        return reduce(lambda cases, r: cases.when(_rule(sequence, r[1]), F.lit(r[0])), enumerate(RULES), F)

    found = found.withColumn("at_line", first(F.col("by_line"))).withColumn("at_paragraph", first(F.col("by_paragraph")))
    rule = F.least("at_line", "at_paragraph")
    joined = F.col("at_line").isNull() | (F.col("at_paragraph") < F.col("at_line"))
    sentences = F.when(joined & F.col("at_paragraph").isNotNull(), F.col("by_paragraph")).otherwise(F.col("by_line"))
    names = F.array(*[F.lit(r.license) for r in RULES])
    free = F.array(*[F.lit(r.permissive) for r in RULES])
    found = found.select("doc_id", rule.alias("rule"), sentences.alias("sequence"))

    def named(name: str, any_of: str, larger: str | None) -> Column:
        own = F.col("sequence").rlike(any_of)
        return F.when(own if larger is None else own & ~F.col("sequence").rlike(larger), F.lit(name))

    every = F.array_join(F.array_compact(F.array(*[named(*p) for p in all_patterns()])), " ")
    sentences, rule = F.col("sequence"), F.col("rule")
    return found.select(
        "doc_id",
        F.get(names, rule).alias("license"),
        F.get(free, rule).alias("permissive"),
        F.when(rule.isNotNull(), every).alias("licenses"),
        F.trim(F.translate(F.regexp_replace(sentences, ",+", " "), ",", "")).alias("sentences"),
    )
