"""Quality rules of texts, as a short-circuit cascade of column expressions.

Each rule's cost and selectivity are estimated on a sample; the rules that reject
most per second come first, and a row is tested only until one rejects it. A rule works
out from the text what it needs beyond the counts that every row reports, so rules
cost what their own metric costs, and nothing for rows rejected before. The
verdict is the same in any order.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.llm.sampling import is_among, place_of
from streamlookup.sources.shared import written

# Rows on which rules are estimated, about, and how often each is timed.
SAMPLE_ROWS = 1_000
RUNS = 3

# Seconds that cannot be told apart on the sample: rules that cost no more are ordered by what they reject.
LEAST_SECONDS = 0.02

# White space, and what counts as a symbol.
_SYMBOL = r"[#*$%&|<>]"
_BLANK = r"[\x20\x09-\x0D]"
_GAP = _BLANK + "+"
_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for rows that the rule rejects; NULL counts as passing."""

    name: str
    fails: Column


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float  # share of the sample

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, LEAST_SECONDS)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _GAP), "")


def matches_of(text: Column, pattern: str) -> Column:
    """How many times a pattern, of one character, is found in a text."""
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, the first one included.

    Windows are compared by their hash. Only if any is repeated, they are sorted
    with their place; the places of repeated ones then cover three words each.
    """
    window = lambda i: F.xxhash64(*[F.element_at(words, i + F.lit(k)) for k in range(3)])
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - 2), window)

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: _cover(F.array_sort(F.transform(F.filter(s, lambda x, k: _twin(s, x, k)), lambda x: x["i"]))))

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, counted)).cast("long")


def _twin(placed: Column, x: Column, k: Column) -> Column:
    """Whether a sorted window has an equal neighbour."""
    before = (k > 0) & (F.get(placed, k - 1)["h"] == x["h"])
    after = (k < F.size(placed) - 1) & (F.get(placed, k + 1)["h"] == x["h"])
    return before | after


def _cover(places: Column) -> Column:
    """How many words windows at these ascending places cover."""

    def cover(p: Column) -> Column:
        gap = lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))
        return F.aggregate(F.transform(p, gap), F.lit(0), lambda total, x: total + x)

    return let(places, cover)


def metrics(text: Column) -> Column:
    """A struct of counts over the whole text."""
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines_of(text),
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        ),
    )
    visible = F.length(F.regexp_replace(text, _BLANK, "")).cast("long")
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        visible.alias("word_chars"),
        matches_of(text, _SYMBOL).alias("n_symbols"),
    )


# The names of the counts that every document's row is asked for.
METRICS = ("n_words", "n_repeat_words", "n_dup_lines", "word_chars", "n_symbols")

# All its counts, in the order of the row.
COUNTS = ("n_words", "n_distinct", "n_repeat_words", "n_lines", "n_dup_lines", "word_chars", "n_symbols")


def with_metrics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the counts of ``COUNTS``."""
    measured = docs.select("doc_id", text_column().alias("text")).withColumn("m", metrics(F.col("text")))
    return measured.select("doc_id", "text", "m.words.*", "m.lines.*", "m.word_chars", "m.n_symbols")


def document_rules() -> list[Rule]:
    """Rules over ``with_metrics``. They look at writing, not at a language."""
    n, text = F.col("n_words"), F.col("text")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > 3 * n),
        Rule("word_length", (F.col("word_chars") > 20 * n) | (F.col("word_chars") < 2 * n)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("exclamations", 5 * matches_of(text, "!") > n),
        Rule("capitals", 2 * matches_of(text, r"\p{Lu}") > F.col("word_chars")),
        Rule("few_distinct_words", 10 * F.col("n_distinct") < n),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def estimate(sample: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """Seconds and rejections of each rule on a sample of rows, which is stored first, with
    the counts that all rows have: a rule's seconds are those of its own metric."""
    sample = written(sample, "rule-sample")

    def timed(rejects: Column) -> tuple[float, float]:
        asked = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if(rejects).alias("rejected"))
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            row = asked.first()
            seconds = time.perf_counter() - start
            best = seconds if best is None else min(best, seconds)
        return best, row["rejected"] / max(row["n"], 1)

    nothing, _ = timed(F.lit(False))
    found = [timed(rule.fails) for rule in rules]
    return [Estimate(rule.name, max(s - nothing, 0.0), share) for rule, (s, share) in zip(rules, found)]


def by_gain(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """The rules that reject most per second first; ties in the order given."""
    gain = {e.name: e.gain for e in estimates}
    return sorted(rules, key=lambda rule: -gain[rule.name])


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects a row, else NULL. The rules behind it
    are not worked out for that row."""
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(F.coalesce(rule.fails, F.lit(False)), F.lit(rule.name)).otherwise(first)
    return first


def judge_documents(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """A row per document with its counts, ``base_failed``, ``kept`` and ``rejected_by``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A NULL text has
    no words, and fails. Repeated rows have a row each, an empty table none. Nothing
    is shuffled, and all is done by column expressions.
    """
    rules = list(rules or document_rules())
    # The same documents however the table is partitioned.
    sample = docs.where(is_among(place_of("doc_id", "text"), SAMPLE_ROWS, docs.count()))
    ordered = by_gain(rules, estimate(with_metrics(sample), rules))
    measured = with_metrics(docs)
    failed = base_failed()
    found = measured.withColumn("base_failed", failed).withColumn(
        "rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(ordered))
    )
    return found.select("doc_id", *COUNTS, "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by")
