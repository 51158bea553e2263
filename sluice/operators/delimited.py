"""Delimited-line operators: regex split, fixed-width expansion, record-type filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null

# --- fixed values ------------------------------------------------------------------------
DEFAULT_DELIMITER = r"\t"   # text default (a regex)
DEFAULT_LABEL = "column"    # expanded columns are column1..columnN
ALL_RECORDS = "ALL"         # record-type filter switched off (any case)
# ----------------------------------------------------------------------------------------


def split_fields(value: Column, regex: str = DEFAULT_DELIMITER) -> Column:
    """Array of fields; trailing empty fields are kept."""
    return F.split(value, regex, -1)


def field_names(n: int, label: str = DEFAULT_LABEL) -> list[str]:
    return [f"{label}{i + 1}" for i in range(n)]


def expand_fields(df: DataFrame, n: int, regex: str = DEFAULT_DELIMITER,
                  label: str = DEFAULT_LABEL, value_col: str = "value",
                  trim: bool = True, null_blank: bool = True, keep=None) -> DataFrame:
    """Exactly ``n`` columns ``{label}1..n`` from a split line in one projection.

    Short lines give NULL past their end (``get``, not ``getItem``, which fails under ANSI),
    long lines are cut. ``keep`` lists pass-through columns (default: all but ``value_col``).
    """
    fields = split_fields(F.col(value_col), regex)
    out = []
    for i, name in enumerate(field_names(n, label)):
        c = F.get(fields, i)
        if null_blank:
            c = blank_to_null(c)
        elif trim:
            c = F.trim(c)
        out.append(c.alias(name))
    keep = [c for c in df.columns if c != value_col] if keep is None else list(keep)
    return df.select(*out, *keep)


def record_type(df: DataFrame, value: str, label: str = DEFAULT_LABEL) -> DataFrame:
    """Keep rows whose first field equals ``value`` exactly; ``ALL`` (any case) keeps all."""
    if value is None or value.upper() == ALL_RECORDS:
        return df
    return df.filter(F.col(f"{label}1") == F.lit(value))
