"""Sanitising projections and the pre-load length audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ident
from ..functions.text import strip_zero_fraction as _strip


def stringify(df: DataFrame) -> DataFrame:
    """Every column cast to string and trimmed, in one projection."""
    return df.select(*[F.trim(ident(c).cast("string")).alias(c) for c in df.columns])


def strip_zero_fraction(df: DataFrame, cols) -> DataFrame:
    """Remove a zero-only decimal tail from the named columns (others untouched)."""
    wanted = {c.lower() for c in ([cols] if isinstance(cols, str) else cols)}
    return df.select(*[
        (_strip(ident(c)) if c.lower() in wanted else ident(c)).alias(c)
        for c in df.columns])


def max_lengths(df: DataFrame, cols=None) -> DataFrame:
    """``(column, max_len)`` for every column, from one aggregation pass (not one per column)."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.max(F.length(ident(c).cast("string"))).cast("long").alias(f"m{i}")
                   for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("max_len"))
                      for i, c in enumerate(cols)])
    return agg.select(F.inline(pairs))
