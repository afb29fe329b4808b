"""Sharding by proportional stratified interleaving.

The rows of each stratum are ranked in a seeded random order. A row's fractional rank,
its place among the rows of its stratum as a share of them, says how far through the stratum
it stands; sorted by it, all strata run side by side, each at its own pace. Cut into equal
parts, every part has the mixture of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlookup.operators.sizing import fits
from streamlookup.sources.shared import written

SHARDS = 16
SEED = "shards"


def _placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows, sorted and stored, with the number ``_file`` of their file (in the sort's order)
    and their place ``_row`` in it: sorted rows are numbered by counts per file."""
    stored = written(rows.repartitionByRange(*order).sortWithinPartitions(*order), name)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    return stored.select("*", number.alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _before(partition: Sequence[str] = ()) -> Column:
    """Rows in the files before, of counts per file."""
    earlier = Window.partitionBy(*partition).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def _joined(rows: DataFrame, counts: DataFrame, on: Sequence[str]) -> DataFrame:
    counts = F.broadcast(counts) if fits(counts) else counts.hint("merge")
    return rows.join(counts, list(on))


def interleave(
    rows: DataFrame, stratum: str, key: Sequence[str], shards: int = SHARDS, seed: str = SEED
) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (place in the shard, gapless from 0) to rows.

    ``shards`` shards get row counts at most one apart, and of each value of ``stratum`` a share in
    proportion. The random order is that of ``md5(seed, key)``, then the key's values, so it hangs on nothing but
    the rows; rows that are alike in ``key`` and stratum may change places. NULL strata are
    one stratum with the empty one; a NULL in the key is a value like any other. An empty table stays
    empty. Other columns are kept, columns named like the two added ones are replaced.

    Two sorts over all tasks; no stratum, however large, and no shard passes through one task. Counts
    per file and stratum are all that is summed up; the running sum over files is of as many rows as
    there are shuffle partitions. All columns go through both sorts: give the narrow ones and
    join texts to the result, or give whole rows to write the shards out with :func:`write_shards`.
    """
    if shards < 1:
        raise ValueError(f"there must be a shard at least, got {shards}")
    rows = rows.drop("shard", "slot")
    named = {f"c{i}": c for i, c in enumerate(rows.columns)}
    number = {c: k for k, c in named.items()}
    plain = rows.toDF(*named)
    keys = [number[c] for c in key]
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    plain = plain.withColumn("_stratum", F.coalesce(F.col(number[stratum]).cast("string"), F.lit("")))
    plain = plain.withColumn("_mix", F.md5(text))

    mixed = _placed(plain, ["_stratum", "_mix", *keys], "mixed")
    spans = mixed.groupBy("_stratum", "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    spans = written(spans, "spans").select(
        *("_stratum", "_file", "_first"),
        _before(["_stratum"]).alias("_base"),
        F.sum("_n").over(Window.partitionBy("_stratum")).alias("_total"),
    )
    ranked = _joined(mixed, spans, ["_stratum", "_file"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_row") - F.col("_first"))
    # The middle of a row's part of its stratum; equal ones go by stratum.
    ranked = ranked.withColumn("_through", (F.col("_rank") + F.lit(0.5)) / F.col("_total").cast("double"))
    ranked = ranked.drop("_mix", "_file", "_row", "_first", "_base", "_total")

    sorted_rows = _placed(ranked, ["_through", "_stratum", "_rank"], "interleaved")
    files = written(sorted_rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")), "files")
    total = files.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    found = _joined(sorted_rows, files.select("_file", _before().alias("_base")), ["_file"])
    # Shard s has the places from ceil(s * total / shards) on.
    found = found.withColumn("_place", F.col("_base") + F.col("_row"))
    shard = F.expr(f"_place * {shards} div {max(total, 1)}")
    found = found.withColumn("shard", shard.cast("int"))
    start = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    found = found.withColumn("slot", F.col("_place") - start)
    return found.select(*[F.col(k).alias(c) for k, c in named.items()], "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Each document's shard, by its ``source``.

    Reads ``doc_id``, ``text`` and ``source``. Returns per row ``doc_id``, ``size`` (UTF-8 bytes of the
    text, none for NULL, plus 1), ``text_crc32``, ``law`` (always ``rows``: counts at most one apart), ``shard``,
    ``slot`` and ``grown_shard`` (NULL: a further shard moves rows between all). Texts are read once and never
    shuffled. Equal texts need not be in one shard, as the mixture decides.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("source").alias("stratum"),
    )
    found = interleave(written(narrow, "sizes"), "stratum", ["doc_id", "size", "text_crc32"], shards, seed)
    return found.select(
        *("doc_id", "size", "text_crc32"),
        F.lit("rows").alias("law"),
        *("shard", "slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(placed: DataFrame, folder: str) -> None:
    """Write rows with ``shard`` and ``slot`` as Parquet, a folder per shard. Files hold
    ranges of slots in order, so a shard is written by many tasks."""
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
