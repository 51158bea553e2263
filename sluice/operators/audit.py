"""Audit and file-metadata columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import base_name, bill_cycle, uuid7
from ..functions.text import ident
from ..session import scratch_path
from .stamp import FILE_COL, ROW_COL

# --- fixed values: audit / metadata column names of the reference --------------------------
AUDIT_ROW = "rownumber"
AUDIT_CYCLE = "billcycle"
AUDIT_FILE = "filename"
AUDIT_ID = "sequencialid"
AUDIT_TIME = "dateprocessed"
META_FILE = "filename"
META_TIME = "dateread"
# ----------------------------------------------------------------------------------------


def _file_name(df: DataFrame, file_name) -> Column:
    if file_name is not None:
        return F.lit(file_name) if isinstance(file_name, str) else file_name
    if "filename" in df.columns:
        return F.col("filename")
    return base_name(FILE_COL)


def audit_columns(df: DataFrame, file_name=None, cycle=None) -> DataFrame:
    """Data columns + ``rownumber, billcycle, filename, sequencialid, dateprocessed``.

    File name and cycle come from each row's source file unless given; the id is a UUIDv7
    and the time is one value per query.
    """
    name = _file_name(df, file_name)
    cyc = bill_cycle(name) if cycle is None else (F.lit(cycle) if isinstance(cycle, str) else cycle)
    data = [c for c in df.columns if c not in (FILE_COL, ROW_COL, "filename")]
    return df.select(*[ident(c) for c in data],
                     F.col(ROW_COL).alias(AUDIT_ROW), cyc.alias(AUDIT_CYCLE),
                     name.alias(AUDIT_FILE), uuid7().alias(AUDIT_ID),
                     F.current_timestamp().alias(AUDIT_TIME))


def file_columns(df: DataFrame, file_name=None) -> DataFrame:
    """Main-table metadata ``filename`` and ``dateread``; helper columns dropped."""
    name = _file_name(df, file_name)
    data = [c for c in df.columns if c not in (FILE_COL, ROW_COL, "filename")]
    return df.select(*[ident(c) for c in data], name.alias(META_FILE),
                     F.current_timestamp().alias(META_TIME))


def main_columns(df: DataFrame, row_label: str | None = None,
                 within: str | None = None) -> DataFrame:
    """Rows for the main table: data columns, without helper columns.

    ``row_label`` adds a number over all files: files in path order, rows in file order (see
    :func:`file_bases`); rows that a filter took out leave gaps. ``within`` names a column of
    ``df`` that is kept and whose values number their files each from 1.
    """
    helpers = (FILE_COL, ROW_COL, "filename", within)
    data = [ident(c) for c in df.columns if c not in helpers]
    if within:
        data.append(ident(within))
    if not row_label:
        return df.select(*data)
    file = FILE_COL if FILE_COL in df.columns else "filename"
    base = file_bases(df, file, within)
    joined = df.join(base, F.col(file).eqNullSafe(F.col("_of")) & (
        F.col(within).eqNullSafe(F.col("_in")) if within else F.lit(True)))
    return joined.select(*data, (F.col("_base") + F.col(ROW_COL)).alias(row_label))


def file_bases(df: DataFrame, file: str = FILE_COL, within: str | None = None,
               ranges: int | None = None) -> DataFrame:
    """Per file (``_of``; per value of ``within``, ``_in``) the last numbers of all files before
    it (``_base``): a prefix sum on two levels, so no task sees all files.

    Files are dealt to ``ranges`` ranges of names (shuffle partitions by default) and written
    to the shared folder. The sums of the ranges – that many longs – pass through the driver and
    become the ranges' starts; inside a range a window adds up its own files.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.col(within) if within else F.lit(0)
    last = df.groupBy(group.alias("_in"), F.col(file).alias("_of")).agg(
        F.max(ROW_COL).alias("_last"))
    path = scratch_path(spark, "file-ranges")
    ranged = last.repartitionByRange(ranges, "_in", "_of").withColumn(
        "_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    starts, total = {}, 0
    for r in sorted(ranged.groupBy("_range").agg(F.sum("_last").alias("n")).collect()):
        starts[r["_range"]] = total
        total += r["n"] or 0
    own = Window.partitionBy("_range").orderBy("_in", "_of")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit([starts.get(i, 0) for i in range(max(starts, default=0) + 1)])
    base = ranged.select("_in", "_of", (
        F.get(start, F.col("_range")) + F.coalesce(F.sum("_last").over(before), F.lit(0))
    ).alias("_base"))
    if not within:
        return base.select("_of", "_base")
    # all numbers before a value of ``within`` are those before its first file
    first = base.groupBy(F.col("_in").alias("_first_in")).agg(F.min("_base").alias("_first"))
    base = base.join(first, F.col("_in").eqNullSafe(F.col("_first_in")))
    return base.select("_in", "_of", (F.col("_base") - F.col("_first")).alias("_base"))
