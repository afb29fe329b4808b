"""Best-fit packing of token sequences into fixed-size training sequences.

The plan is made over the histogram of lengths, not over documents: best-fit
decreasing moves whole runs of equal lengths into runs of equally filled
sequences. It yields slots, numbered within each length, and the pieces take
them by a join on their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_slices
from streamlookup.llm.word_ids import ID_BYTES, id_bytes, word_encoder
from streamlookup.sources.shared import written

# Tokens in a packed sequence.
CAPACITY = 4096

# Consecutive rows of a stored file that are ranked together; bounds a sort.
BLOCK_ROWS = 50_000

# Slots of a run that are written out together; bounds what one row expands to.
SLOT_RUN = 10_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Returns ``(length, rank, count, sequence, offset)``: the pieces of that length
    ranked ``rank`` to ``rank + count - 1`` go to sequences from ``sequence`` on, one
    each, at ``offset``. Its size depends on the lengths there are, hardly on how
    many pieces there are. Lengths must be from 1 to ``capacity``.
    """
    if bad := [length for length in histogram if not 1 <= length <= capacity]:
        raise ValueError(f"lengths must be from 1 to {capacity}, got {sorted(bad)[:3]}")
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> runs (first sequence, count)
    rooms = 0  # bit r is set if some sequence has room r
    sequences, rows = 0, []

    def add(room: int, first: int, count: int) -> None:
        nonlocal rooms
        if room and count:
            free[room].append((first, count))
            rooms |= 1 << room

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if not (fitting := rooms >> length):
                count = -(-left // (capacity // length))
                add(capacity, sequences, count)
                sequences += count
                continue
            room = length + (fitting & -fitting).bit_length() - 1
            first, count = free[room].pop()
            if not free[room]:
                rooms &= ~(1 << room)
            # The tightest sequence stays the tightest until it is full.
            each = room // length
            filled = min(count, left // each)
            if not filled:
                filled, each = 1, left
            for i in range(each):
                rows.append((length, rank + i * filled, filled, first, capacity - room + i * length))
            rank += each * filled
            left -= each * filled
            add(room - each * length, first, filled)
            add(room, first + filled, count - filled)
    return rows


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of up to ``capacity`` tokens.

    Pieces of a sequence follow each other without a gap, from offset 0. Equal
    rows get a place each. A NULL or zero length takes no place: both columns
    are NULL. An empty table gives an empty result; a length above ``capacity``
    is an error. Other columns are kept as they are; columns named like the two
    added ones are replaced.

    The pieces are written once, which gives each a fixed place (file, row). One
    rank per length is made of counts per block of rows and the rank inside the
    block, so pieces of one common length are ranked by many tasks. To the driver
    come at most ``capacity`` counts.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    named = {f"c{i}": c for i, c in enumerate(pieces.columns)}
    stored = written(pieces.toDF(*named), "pieces")
    size = F.col(next(k for k, c in named.items() if c == length)).cast("long")
    stored = stored.select(
        "*",
        F.coalesce(size, F.lit(0)).alias("_length"),
        F.col("_metadata.file_name").alias("_file"),
        F.floor(F.col("_metadata.row_index") / block_rows).alias("_block"),
        F.col("_metadata.row_index").alias("_row"),
    )
    block = ["_length", "_file", "_block"]
    counts = written(stored.groupBy(*block).count(), "counts")
    histogram = counts.groupBy("_length").agg(F.sum("count").alias("n")).collect()
    rows = plan({r["_length"]: r["n"] for r in histogram if r["_length"]}, capacity)
    names = ["_length", "_rank", "_count", "sequence_id", "offset"]
    import pandas as pd  # here, as workers import this module and do without

    planned = spark.createDataFrame(pd.DataFrame(rows, columns=names, dtype="int64"), ", ".join(f"{n} long" for n in names))
    # Long runs are cut first, so that many tasks write out their slots.
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1, F.lit(SLOT_RUN).cast("long")))
    slots = planned.withColumn("_from", cut).repartition("sequence_id", "offset", "_from")
    last = F.least(F.col("_from") + SLOT_RUN, "_count") - 1
    slots = slots.withColumn("_i", F.explode(F.sequence("_from", last))).select(
        "_length", (F.col("_rank") + F.col("_i")).alias("_rank"), (F.col("sequence_id") + F.col("_i")).alias("sequence_id"), "offset"
    )
    before = Window.partitionBy("_length").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*block, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("_row")) - 1
    ranked = stored.withColumn("_inside", inside).join(bases.hint("merge"), block)
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_inside"))
    placed = ranked.join(slots.hint("merge"), ["_length", "_rank"], "left")
    return placed.select(*[F.col(k).alias(c) for k, c in named.items()], "sequence_id", "offset")


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, cached_bytes: int | None = None
) -> DataFrame:
    """The token ids of whole texts, with ``end_id`` behind each, cut to ``capacity``.

    ``docs`` has ``doc_id`` and ``text``; a NULL text counts as empty, so each row
    has at least the end id. Rows of the same ``doc_id``, or with none, are packed
    each for itself. Returns ``PIECES``, and no text. ``cached_bytes`` bounds what a worker remembers of words: less
    is slower, and leaves more memory to the other stages of a job.
    """
    step = capacity * ID_BYTES
    end = id_bytes([end_id])

    def pieces(doc_ids: list, texts: list) -> dict:
        rows = []
        for doc_id, ids in zip(doc_ids, word_encoder(tokenizer, cached_bytes).encode(texts)):
            ids += end
            for at in range(0, len(ids), step):
                part = ids[at : at + step]
                rows.append((doc_id, at // step, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part)))
        columns = zip(*rows) if rows else [()] * 5
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), columns))

    return map_slices(docs.select("doc_id", "text"), pieces, PIECES)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, cached_bytes: int | None = None
) -> DataFrame:
    """Pack whole documents: ``token_pieces`` with their ``sequence_id`` and ``offset``."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity, cached_bytes), capacity=capacity)
