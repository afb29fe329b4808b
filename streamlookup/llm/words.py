"""Words of texts as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from streamlookup.llm.caches import take_turn

# Odd multiplier of the rolling hash, and the constants of its final mixing.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def hashes_of(words: list) -> np.ndarray:
    """The hash of each word; hashing one is faster than remembering it."""
    take_turn(None)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


# Scripts that put no blanks between words (Thai, Lao, Tibetan, Burmese,
# Khmer, kana, Han); each of their letters counts as a word.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")


def plain_words(text: str | None) -> list[str]:
    """Letters and digits only, in lower case: what a copy keeps though its
    punctuation or line ends differ. Scripts without blanks go letter by letter."""
    return _WORD.findall((text or "").lower())


def _powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class RunningHash:
    """Karp-Rabin hashes of all runs of a sequence, from its prefix sums.

    A run's hash is the sum of its words' hashes times the powers of ``BASE``,
    modulo 2**64, whatever its place.
    """

    def __init__(self, words: np.ndarray):
        powers = _powers(len(words), BASE)
        self.prefix = np.r_[np.uint64(0), np.cumsum(words * powers, dtype=np.uint64)]
        self.back = _powers(len(words) + 1, pow(BASE, -1, 1 << 64))

    def runs(self, length: int) -> np.ndarray:
        """The hash of each run of ``length`` words."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return (self.prefix[length:] - self.prefix[:n]) * self.back[:n]
