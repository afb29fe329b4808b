"""Bloom filters over keys, as small tables that scans are pruned with."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlookup.operators.sizing import BROADCAST_LIMIT
from streamlookup.sources.shared import written

# Bits per key if there is room, the fewest that are of use, and how many of them a key sets.
BITS_PER_KEY = 10
LEAST_BITS = 4
HASHES = 4

# Fixed value: bits of one of Spark's bitmaps.
_BLOCK_BITS = 32768


@dataclass(frozen=True)
class Bloom:
    """A filter in blocks: a key belongs to one block, in which it sets ``HASHES`` bits."""

    blocks: DataFrame  # block, bits
    count: int


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i + 1), key), F.lit(_BLOCK_BITS)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, key: Column, n_keys: int, limit: int = BROADCAST_LIMIT) -> Bloom | None:
    """A filter of distinct, non-null keys, made of ``n_keys`` or fewer; None if one of use would be beyond ``limit`` bytes.

    Bits are set per block in an aggregate that combines before the shuffle; what comes out is stored, and
    has a known size: a block is 4 KiB.
    """
    most = limit // (_BLOCK_BITS // 8)
    blocks = max(1, -(-n_keys * BITS_PER_KEY // _BLOCK_BITS))
    if blocks > most:
        blocks = most
        if blocks * _BLOCK_BITS < n_keys * LEAST_BITS:
            return None
    places = keys.select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
    return Bloom(written(places.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")), "bloom"), blocks)


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def prune(df: DataFrame, key: Column, bloom: Bloom) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and about one in eighty of the rest at
    ``BITS_PER_KEY``. Nothing of ``df`` is shuffled; rows with a NULL key go."""
    named = df.withColumn("__bloom_key", key)
    key = F.col("__bloom_key")
    side = bloom.blocks.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    joined = named.join(F.broadcast(side), _block(key, bloom.count) == F.col("__block"))
    found = joined.where(key.isNotNull())
    for bit in _bits(key):
        found = found.where(_is_set(F.col("__bits"), bit))
    return found.drop("__bloom_key", "__block", "__bits")
