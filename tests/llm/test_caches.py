"""Caches bounded in bytes."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from streamlookup.llm.caches import Generations, take_turn


def made(most, keep=lambda key: True):
    asked = []
    cache = Generations(lambda key: asked.append(key) or key * 2, most, keep)
    return cache, asked


def test_values_are_made_once_while_there_is_room():
    cache, asked = made(1 << 20)
    assert [cache[k] for k in (1, 2, 1, 2)] == [2, 4, 2, 4] and asked == [1, 2]


def test_what_is_used_often_stays_and_size_is_bounded():
    cache, asked = made(20_000)
    for i in range(10_000):
        assert cache[i] == 2 * i and cache[-1] == -2
        assert cache.held <= 20_000 // 2 + 200 and len(cache.old) + len(cache) < 200
    assert asked.count(-1) == 1 and len(asked) == 10_001


def test_keys_not_to_be_kept():
    cache, asked = made(1 << 20, lambda key: key < 10)
    assert [cache[k] for k in (50, 50, 5, 5)] == [100, 100, 10, 10] and asked == [50, 50, 5]


def test_another_cache_releases_the_last():
    one, other = made(1 << 20)[0], made(1 << 20)[0]
    take_turn(one)
    one[1]
    take_turn(one)
    assert len(one) == 1
    take_turn(other)
    assert not one and not one.old and one.held == 0
    assert one[1] == 2
    other[1]
    take_turn(None)
    assert not other and len(one) == 1
    take_turn(None)


def test_what_is_forgotten_goes_back_to_the_system():
    """Freed pieces between ones still in use: the process gets smaller when another stage begins."""

    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    cache = Generations(lambda key: bytes(4000), 1 << 30)
    take_turn(cache)
    kept = []
    for i in range(50_000):
        cache[i]
        if i % 100 == 0:
            kept.append(bytes(4000))
    before = resident()
    take_turn(None)
    assert before - resident() > 100_000_000 and len(kept) == 500


def test_workers_of_the_pipeline_do_without_pandas():
    """What they import stays in each worker's memory: no stage's module brings pandas along."""
    stages = ("quality_classifier", "near_dedup", "decontamination", "secret_scan", "packing")
    modules = ", ".join(f"streamlookup.llm.{name}" for name in stages)
    root = Path(__file__).parents[2]
    code = f"import sys, pyspark.worker, {modules}; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, check=False).returncode == 0
