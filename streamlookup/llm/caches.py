"""What a worker remembers from one slice to the next, bounded in bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from sys import getsizeof
from typing import Any

# A dictionary's own bytes for an entry, about.
_ENTRY = 100


class Generations(dict):
    """Remembers ``make(key)`` in two generations.

    What is asked for is in the young one. When that has half of ``most_bytes`` it becomes the
    old one and the old one is forgotten, so what is asked for again and again is never
    lost, however many keys come once. ``keep`` says which keys to remember at all.
    """

    def __init__(self, make: Callable[[Any], Any], most_bytes: int, keep: Callable[[Any], bool] = lambda key: True):
        super().__init__()
        self.make, self.most, self.keep = make, most_bytes, keep
        self.old: dict = {}
        self.held = 0

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if not self.keep(key):
                return value
        if 2 * self.held > self.most:
            self.old = {}
            self.old = dict(self)
            super().clear()
            self.held = 0
        self.held += _ENTRY + getsizeof(key) + getsizeof(value)
        self[key] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.old, self.held = {}, 0


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker keeps what earlier tasks
    have freed in pieces, next to what later ones need."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_last: list[Generations] = []


def take_turn(cache: Generations | None) -> None:
    """Say that ``cache`` is used now, or None of them. Workers live longer than the stages of a job: what
    another stage remembered is released as soon as this one begins."""
    if _last and _last[0] is not cache:
        _last.pop().clear()
        give_back()
    if cache is not None:
        _last[:] = [cache]
