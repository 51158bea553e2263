"""Line-oriented text scan (one row per line, blank lines kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import MISSING_FILE, IntakeError
from ..operators.stamp import with_position
from .files import split_existing


def read_lines(spark: SparkSession, paths, positioned: bool = True,
               on_missing: str = "raise") -> DataFrame:
    """``value STRING`` per line of every file; with ``positioned`` the scan also carries path
    and split for :func:`sluice.operators.stamp.stamp_rows`.

    Missing inputs raise :class:`IntakeError` (``missing_file``) or, with
    ``on_missing='skip'``, are left out (report them with ``split_existing``).
    """
    found, missing = split_existing(spark, paths)
    if missing and (on_missing == "raise" or not found):
        raise IntakeError(MISSING_FILE, "input object not found", ",".join(missing))
    df = spark.read.text(found)
    return with_position(df) if positioned else df
