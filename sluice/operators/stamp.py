"""Dense 1-based row numbers in file order, in one scan, without a single-partition stage.

A file scan reads every split (``_metadata.file_block_start``) sequentially inside one task, so
the position of a row in its split is a running count that starts anew with each split: an
Arrow function that gets one long per row (a hash of file and split start) and gives one back,
all other columns stay in the JVM. The number of a row is

    (rows in earlier splits of the same file) + (position in its split).

A split that is its whole file (``file_block_length = file_size``) has no earlier ones, so files
of one split are numbered in the scan that reads them. Only files that may have been cut
(larger than the smallest split Spark makes) are counted first: their per-split counts are
aggregated (map-side partial aggregation, one row per split), turned into running offsets per
file, checkpointed to the shared folder and joined back. Nothing depends on how Spark packs
splits into tasks; if files are cut elsewhere in the data pass than in the counting pass (the
caller changed a scan setting in between), a split that was not counted fails the read.

The join is a broadcast only when the checkpointed offsets table's measured size (rows ×
path length + two longs) is within a limit – about 2M splits of 128 MB, i.e. ~250 TB of
input, fit in 512 MB; beyond it a shuffle join on (file, split) is used, whose groups are at
most one split each. Data rows are never moved to one partition, and a file holding a third
of all rows is still numbered by as many tasks as it has splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import decoded_path
from ..session import shared_root

FILE_COL = "_file"
NAME_COL = "filename"
BLOCK_COL = "_block"
LENGTH_COL = "_block_length"
SIZE_COL = "_size"
SCAN_NAME = "_name"
ROW_COL = "_temp_row_num"
POSITION = (FILE_COL, SCAN_NAME, BLOCK_COL, LENGTH_COL, SIZE_COL)

#: Largest offsets table (one row per file split, measured in bytes) that is broadcast.
BROADCAST_BYTES_LIMIT = 512 * 1024 * 1024
_ROW_OVERHEAD = 40          # two longs plus row header, per split


def with_position(df: DataFrame) -> DataFrame:
    """Attach path, file name, split and file size. Call directly on a file scan."""
    meta = [f"_metadata.{c}" for c in ("file_path", "file_name", "file_block_start",
                                       "file_block_length", "file_size")]
    return df.select("*", *[F.col(m).alias(c) for m, c in zip(meta, POSITION)])


def positions(keys: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Running counts of equal consecutive keys, from 1, across batches."""
    last, seen = None, 0
    for batch in keys:
        key = batch.to_numpy(zero_copy_only=False)
        if len(key):
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            at = np.arange(1, len(key) + 1) - np.repeat(starts, sizes)
            if key[0] == last:
                at[:sizes[0]] += seen
            last, seen = key[-1], int(at[-1])
            yield pa.array(at, pa.int64())
        else:
            yield pa.array([], pa.int64())


def split_position() -> Column:
    """Position of a row in its split, for the rows of :func:`with_position` as they are read.
    It is marked as not deterministic, so no filter moves below it."""
    udf = F.arrow_udf(positions, "long").asNondeterministic()
    return udf(F.xxhash64(FILE_COL, BLOCK_COL))


def uncut_size(spark: SparkSession) -> int:
    """Files up to this size are always one split: the smaller of Spark's largest split and the
    size it reckons for opening a file."""
    conf = spark._jsparkSession.sessionState().conf()
    return min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())


def split_counts(positioned: DataFrame) -> DataFrame:
    """Rows per split (``_n``) of the files that may have been cut; smaller ones are not read
    (Spark drops them from the scan by their size)."""
    large = positioned.filter(F.col(SIZE_COL) > uncut_size(positioned.sparkSession))
    return large.groupBy(FILE_COL, BLOCK_COL).agg(F.count(F.lit(1)).alias("_n"))


def split_offsets(counts: DataFrame) -> DataFrame:
    """Per (file, split) of the counts: rows in earlier splits of the file (``_base``)."""
    earlier = (Window.partitionBy(FILE_COL).orderBy(BLOCK_COL)
               .rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(FILE_COL, BLOCK_COL,
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))


def stamp_rows(positioned: DataFrame, row_col: str = ROW_COL,
               broadcast_bytes: int = BROADCAST_BYTES_LIMIT,
               keep_position: bool = False, offsets: DataFrame | None = None) -> DataFrame:
    """Add ``filename`` (decoded) and ``row_col`` (1..N per file in file order).

    ``positioned`` comes from :func:`with_position`, with all rows of its scan. ``offsets``
    (of :func:`split_offsets`, as stored) spares the counting pass of files of several splits.
    """
    shared_root(positioned.sparkSession)
    if offsets is None:
        offsets = split_offsets(split_counts(positioned)).checkpoint(eager=True)
    size = offsets.agg(F.sum(F.length(FILE_COL) + _ROW_OVERHEAD).alias("b")).first()["b"]
    placed = positioned.withColumn("_at", split_position())
    whole = F.col(LENGTH_COL) == F.col(SIZE_COL)
    base = F.lit(None).cast("long")
    if size:
        right = F.broadcast(offsets) if size <= broadcast_bytes else offsets
        placed, base = placed.join(right, [FILE_COL, BLOCK_COL], "left"), F.col("_base")
    number = F.when(whole, F.col("_at")).when(
        base.isNull(), F.raise_error(F.lit("file splits changed between numbering passes"))
    ).otherwise(base + F.col("_at"))
    name = F.when(F.contains(SCAN_NAME, F.lit("%")), decoded_path(SCAN_NAME)).otherwise(
        F.col(SCAN_NAME))
    out_cols = [c for c in positioned.columns
                if c == FILE_COL or keep_position or c not in POSITION]
    return placed.select(*out_cols, name.alias(NAME_COL), number.cast("long").alias(row_col))


def in_file_order(df: DataFrame, row_col: str = ROW_COL, file_col: str = FILE_COL) -> DataFrame:
    """Order rows by file and number, for sinks that show order (range-partitioned sort)."""
    cols = [c for c in (file_col, row_col) if c in df.columns]
    return df.orderBy(*cols)
