"""Periodic runs of words: minimizers of several scales propose periods, extension confirms them.

A run is a stretch of words that repeats with a period, three times or more. Inside
it, whatever a window picks by its content it picks again one period further on. So the
least hash of each window of k-grams is marked; where k is no smaller than the period,
the same k-gram cannot come twice within one period, and two neighbouring marks of equal
hash are exactly a period apart. Each scale covers the periods from its ``low`` to half
as many again, with k-grams and windows short enough that every run of three periods holds a
window and its repetition. Periods too short for that are found by comparing the words at
that distance directly.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_slices
from streamlookup.llm.words import RunningHash, mixed

# Words of the shortest run, and its least length in periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3

# Periods found by direct comparison.
DIRECT_PERIODS = 16

# Words of several texts that are looked at together; a longer text is looked at alone.
GROUP_WORDS = 1 << 18

Run = tuple[int, int, int]  # start, length, period

FOUND = (
    "doc_id long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start:long,length:long,period:long>>, collapsed binary"
)


def _least_equal(period: int) -> int:
    """How many words in a row must equal the one a period further on."""
    return max(LEAST_WORDS - period, (LEAST_PERIODS - 1) * period)


def _slide(function, values: np.ndarray, width: int) -> np.ndarray:
    """``function`` (least or greatest) over every window, by doubling its width."""
    size = 1
    while 2 * size <= width:
        values = function(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return function(values[:-rest], values[rest:]) if rest else values


def _marks(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that are the least of some window of ``width``, ties included."""
    least = _slide(np.minimum, hashes, width)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), width) == hashes)


def seeds(codes: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and periods, above ``low`` up to the third value, proposed by that scale."""
    high = 3 * low // 2
    width = 2 * low + 3 - high
    hashes = mixed(RunningHash(mixed(codes.astype(np.uint64) + np.uint64(1))).runs(high))
    if len(hashes) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), high
    marks = _marks(hashes, width)
    values = hashes[marks]
    order = np.argsort(values, kind="stable")
    places, values = marks[order], values[order]
    apart = np.diff(places)
    chosen = (values[1:] == values[:-1]) & (apart > low) & (apart <= high)
    return places[:-1][chosen], apart[chosen], high


def _extent(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` of words that equal the one a period further on."""
    last = len(codes) - period
    end, step = at, 64
    while end < last:
        stop = min(end + step, last)
        differ = codes[end:stop] != codes[end + period : stop + period]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, 2 * step
    start, step = at, 64
    while start > 0:
        stop = max(start - step, 0)
        differ = codes[stop:start] != codes[stop + period : start + period]
        if differ.any():
            start -= int(differ[::-1].argmax())
            break
        start, step = stop, 2 * step
    return start, end


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] if n > 1 else found


def _is_least(codes: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether no smaller period holds: of a run of two periods or more, it would divide this one."""
    end = start + length
    shorter = (period // p for p in _prime_factors(period))
    return not any(np.array_equal(codes[start : end - q], codes[start + q : end]) for q in shorter)


def _direct(codes: np.ndarray, longest: int) -> Iterator[Run]:
    for period in range(1, DIRECT_PERIODS + 1):
        if longest < max(LEAST_WORDS, LEAST_PERIODS * period):
            return
        edges = np.concatenate([[-1], np.flatnonzero(codes[:-period] != codes[period:]), [len(codes) - period]])
        equal = np.diff(edges) - 1
        for i in np.flatnonzero(equal >= _least_equal(period)).tolist():
            yield int(edges[i]) + 1, int(equal[i]) + period, period


def _by_scale(codes: np.ndarray, low: int) -> Iterator[Run]:
    places, periods, _ = seeds(codes, low)
    order = np.lexsort((places, periods))
    period, end = 0, 0
    for at, found in zip(places[order].tolist(), periods[order].tolist()):
        if found == period and at < end:
            continue  # inside the stretch looked at last
        period = found
        start, end = _extent(codes, at, period)
        if end - start >= _least_equal(period):
            yield start, end - start + period, period


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """All runs of each text (a list of words), by start and period.

    The texts are looked at as one sequence with a word of its own behind each, which no
    run can contain: a stretch of equal words across it is shorter than its period.
    """
    numbers = {word: i for i, word in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    codes = np.insert(words, np.cumsum(sizes), len(numbers) + np.arange(len(texts)))
    starts = np.cumsum(sizes + 1) - sizes - 1
    found: list[list[Run]] = [[] for _ in texts]

    def keep(runs: Iterator[Run], codes: np.ndarray, kept: np.ndarray, starts: np.ndarray) -> None:
        for start, length, period in runs:
            if _is_least(codes, start, length, period):
                i = int(np.searchsorted(starts, start, "right")) - 1
                found[kept[i]].append((start - int(starts[i]), length, period))

    kept = np.arange(len(texts))
    keep(_direct(codes, int(sizes.max(initial=0))), codes, kept, starts)
    low = DIRECT_PERIODS
    while True:
        # Only texts that are long enough for a period of this scale.
        long_enough = sizes >= LEAST_PERIODS * (low + 1)
        if not long_enough.any():
            break
        if not long_enough.all():
            codes = codes[np.repeat(long_enough, sizes + 1)]
            kept, sizes = kept[long_enough], sizes[long_enough]
            starts = np.cumsum(sizes + 1) - sizes - 1
        keep(_by_scale(codes, low), codes, kept, starts)
        low = 3 * low // 2
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; of equal ones the first, then the one of smallest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without what runs repeat: of each run its first period stays."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words as they are, or, for a tenth of the ids, from some place on repeating with a period.

    Makes texts with long runs of known shape; an id decides the place and the period.
    Fixed values: the rule of the query's contract. A NULL id changes nothing.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def periodic_runs(docs: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Runs of words of every whole text.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Words are parted by ASCII
    white space. ``prepare`` may change a document's words first. Returns per row
    ``doc_id``, ``n_runs``, the strongest run's ``start``, ``length``, ``period`` (words from 0) and
    ``exponent_milli`` (thousandths of periods, rounded down), all four NULL without a run, ``runs`` (all of them, by start and
    period) and ``collapsed`` (the words without repetitions, one blank between them).

    A NULL or empty text has no word and no run. Repeated rows have a row each, an empty
    table none. Words are compared as they are; only marks are chosen by 64-bit hashes, so
    a run could be missed only by a collision inside it. Nothing is shuffled.
    """

    def find(doc_ids: list, texts: list) -> dict:
        rows = []
        waiting: list[tuple] = []
        held = 0

        def finish() -> None:
            for (doc_id, words), runs in zip(waiting, runs_of([words for _, words in waiting])):
                best = strongest(runs)
                start, length, period = best or (None, None, None)
                milli = 1000 * length // period if best else None
                listed = [dict(zip(("start", "length", "period"), run)) for run in runs]
                rows.append((doc_id, start, length, period, milli, listed, b" ".join(collapsed(words, runs))))
            waiting.clear()

        for doc_id, text in zip(doc_ids, texts):
            words = text.split() if text else []
            if prepare is not None:
                words = prepare(doc_id, words)
            if waiting and held + len(words) > GROUP_WORDS:
                finish()
                held = 0
            waiting.append((doc_id, words))
            held += len(words)
        if waiting:
            finish()
        names = ("doc_id", "start", "length", "period", "exponent_milli", "runs", "collapsed")
        return dict(zip(names, zip(*rows) if rows else [()] * len(names)))

    found = map_slices(docs.select("doc_id", F.col("text").cast("binary")), find, FOUND)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *("start", "length", "period", "exponent_milli", "runs"),
        F.col("collapsed").cast("string").alias("collapsed"),
    )


def run_digests(found: DataFrame) -> DataFrame:
    """``periodic_runs`` with its runs and its collapsed text as SHA-256 digests."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        *("doc_id", "n_runs", "start", "length", "period", "exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
