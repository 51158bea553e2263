"""Headerless CSV scan into a positional grid ``(_file, cells ARRAY<STRING>)``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MISSING_FILE, IntakeError
from ..operators.stamp import (BLOCK_COL, FILE_COL, POSITION, ROW_COL, split_offsets,
                               split_position, with_position)
from ..session import scratch_path, shared_root
from .files import split_existing

DEFAULT_SEP = ","


def infer_width(spark: SparkSession, paths, sep: str = DEFAULT_SEP) -> int:
    """Widest line in separator-delimited fields (one distributed max over all lines).

    Quoted separators over-count, which only adds empty columns. The reference instead
    takes the first line's width, which loses cells when a report starts with a title.
    """
    n = (spark.read.text(paths)
         .agg(F.max(F.size(F.split("value", re.escape(sep), -1))).alias("w"))
         .first()["w"])
    return int(n or 1)


@dataclass(frozen=True)
class CsvPrePass:
    """What one scan over the lines of CSV files tells of them, stored in the shared folder."""
    splits: DataFrame      # per (file, split): _n rows, _w fields of the widest line, first lines
    offsets: DataFrame     # per (file, split): rows in earlier splits of the file
    width: int             # fields of the widest line
    sep: str

    def first_rows(self, n: int) -> DataFrame:
        """``(_file, _temp_row_num, cells)`` of each file's first ``n`` rows, at most as many as
        the pre-pass kept of a split."""
        lines = self.splits.select(FILE_COL, BLOCK_COL, F.inline("first")) \
            .join(self.offsets, [FILE_COL, BLOCK_COL])
        number = F.col("_base") + F.col("at")
        rows = F.from_csv("line", csv_schema(self.width).simpleString()[7:-1].replace(":", " "),
                          {"sep": self.sep})
        return lines.filter(number <= n).select(
            FILE_COL, number.alias(ROW_COL),
            F.array(*[rows[f"_c{i}"] for i in range(self.width)]).alias("cells"))


def csv_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def pre_pass(spark: SparkSession, paths, sep: str = DEFAULT_SEP, width: int | None = None,
             sample: int = 0, on_missing: str = "raise") -> CsvPrePass:
    """Row counts, the first ``sample`` rows and the widest line of every split, from one scan.

    Each split gives one row (partially aggregated where it is read; at most ``sample`` lines in
    it), and a file's rows are put together by the order of its splits. Lines are counted as
    the CSV reader counts rows: those of nothing but spaces and control characters are none.
    """
    found = _found(spark, paths, on_missing)
    lines = with_position(spark.read.text(found))
    fields = F.size(F.split("value", re.escape(sep), -1))
    blank = ~F.col("value").rlike("[^\\x00-\\x20]")
    lines = lines.select(FILE_COL, BLOCK_COL, "value", fields.alias("w"), blank.alias("blank"))
    placed = lines.filter("NOT blank").withColumn("at", split_position())
    first = F.when(F.col("at") <= sample, F.struct("at", F.col("value").alias("line")))
    splits = placed.groupBy(FILE_COL, BLOCK_COL).agg(
        F.count(F.lit(1)).alias("_n"), F.max("w").alias("_w"),
        F.collect_list(first).alias("first"))
    shared_root(spark)
    path = scratch_path(spark, "csv-pre-pass")
    splits.write.parquet(path)
    splits = spark.read.schema(splits.schema).parquet(path)
    offsets = split_offsets(splits).checkpoint(eager=True)
    if width is None:
        width = int(splits.agg(F.max("_w")).first()[0] or 1)
    return CsvPrePass(splits, offsets, width, sep)


def _found(spark: SparkSession, paths, on_missing: str) -> list[str]:
    found, missing = split_existing(spark, paths)
    if missing and (on_missing == "raise" or not found):
        raise IntakeError(MISSING_FILE, "input object not found", ",".join(missing))
    return found


def read_csv_grid(spark: SparkSession, paths, sep: str = DEFAULT_SEP, width: int | None = None,
                  positioned: bool = True, on_missing: str = "raise",
                  options: dict | None = None) -> DataFrame:
    """All-string cells of every line, in an explicit schema ``_c0.._c{width-1}``.

    ``sep`` is a literal (one or more characters). Empty fields read as NULL. Empty and
    whitespace-only lines are skipped by the CSV reader and therefore not numbered.
    Returns ``cells`` plus the columns of :func:`sluice.operators.stamp.with_position` when
    ``positioned``.
    """
    found = _found(spark, paths, on_missing)
    if width is None:
        width = infer_width(spark, found, sep)
    reader = spark.read.schema(csv_schema(width)).option("header", "false").option("sep", sep)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.csv(found)
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("cells")
    if not positioned:
        return raw.select(cells)
    return with_position(raw).select(cells, *POSITION)
