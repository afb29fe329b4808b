"""Lookup tables as files sorted by key, of which a point lookup reads the row groups it needs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlookup.functions.messages import quoted
from streamlookup.sources.shared import open_folder

# Bytes of a row group, about: what one key costs at least.
ROW_GROUP_BYTES = 1024 * 1024

_INDEX = "_index"


def write_keyed(dim: DataFrame, folder: str, key: str, row_group_bytes: int = ROW_GROUP_BYTES, files: int | None = None) -> None:
    """Write a table sorted by a key (numbers or strings), with an index of the key range of each row group.

    Rows without a key are left out, as no lookup finds them. The index is a table itself, read by Spark's tasks from
    the files' own statistics and sorted by key; its size is a few dozen bytes a row group.
    """
    rows = dim.where(quoted(key).isNotNull())
    ranged = rows.repartitionByRange(*([] if files is None else [files]), quoted(key)).sortWithinPartitions(quoted(key))
    # Spark looks at a row group's size after 100 rows and by records from then on; pages are kept small for that.
    ranged.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", max(1024, row_group_bytes // 8)).option(
        "parquet.block.size.row.check.min", 10
    ).parquet(f"{folder}/rows")
    spark = dim.sparkSession
    stored = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    names = stored.select(F.col("_metadata.file_name").alias("file")).distinct()
    kind = rows.schema[key].dataType.simpleString()

    def ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = open_folder(folder)
        for frame in frames:
            found = []
            for name in frame["file"]:
                with files.open_input_file(f"{path}/rows/{name}") as stream:
                    meta = pq.ParquetFile(stream).metadata
                    at = meta.schema.names.index(key)
                    for i in range(meta.num_row_groups):
                        stats = meta.row_group(i).column(at).statistics
                        if stats is None or not stats.has_min_max:
                            raise ValueError(f"{name} has no statistics of {key}")
                        found.append((name, i, stats.min, stats.max))
            if found:
                yield pd.DataFrame(found, columns=["file", "row_group", "low", "high"])

    index = names.mapInPandas(ranges, f"file string, row_group int, low {kind}, high {kind}")
    index.repartitionByRange("low").sortWithinPartitions("low").write.parquet(f"{folder}/{_INDEX}")


def read_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """The whole table."""
    return spark.read.parquet(f"{folder}/rows")


class KeyedFiles:
    """Fetches rows by key from :func:`write_keyed`'s files; give it to ``lookup_by_fetch`` as ``fetch``.

    For a list of keys it reads the part of the index that their range covers, then of each row group
    whose own range holds one of them the wanted columns.
    """

    def __init__(self, folder: str, key: str, columns: Sequence[str] | None = None):
        self.folder, self.key, self.columns = folder, key, list(columns) if columns else None

    def row_groups(self, keys: Sequence) -> pd.DataFrame:
        """``file`` and ``row_group`` of those that may hold a key."""
        files, path = open_folder(self.folder)
        wanted = pd.Series(sorted(keys))
        near = (pc.field("low") <= wanted.iloc[-1]) & (pc.field("high") >= wanted.iloc[0])
        index = pq.read_table(f"{path}/{_INDEX}", filesystem=files, filters=near).to_pandas()
        # The first key that is not below a range has to be in it.
        first = wanted.searchsorted(index["low"])
        inside = first < len(wanted)
        index, first = index[inside], first[inside]
        return index[wanted.iloc[first].to_numpy() <= index["high"].to_numpy()]

    def __call__(self, keys: Sequence) -> pd.DataFrame:
        found = self.row_groups(keys)
        files, path = open_folder(self.folder)
        tables = []
        columns = self.columns and list(dict.fromkeys([self.key, *self.columns]))
        for name, groups in found.groupby("file"):
            with files.open_input_file(f"{path}/rows/{name}") as stream:
                rows = pq.ParquetFile(stream).read_row_groups(sorted(groups["row_group"].tolist()), columns=columns)
                tables.append(rows.to_pandas())
        rows = pd.concat(tables) if tables else pd.DataFrame(columns=columns or [self.key])
        rows = rows[rows[self.key].isin(keys)]
        return rows[self.columns] if self.columns else rows
