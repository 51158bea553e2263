"""Align a frame with a target table's columns in one projection."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ident

log = logging.getLogger(__name__)


def _names(target) -> list[str]:
    if isinstance(target, T.StructType):
        return target.fieldNames()
    return list(target)


def _types(target) -> dict[str, T.DataType]:
    if isinstance(target, T.StructType):
        return {f.name: f.dataType for f in target.fields}
    return {}


def align(df: DataFrame, target, match: str = "insensitive", skip: str | None = None,
          cast: bool = False, on_error: str = "raise") -> DataFrame:
    """Target order and spelling; missing columns NULL; extra columns dropped.

    ``match='insensitive'`` (A1/A3/A4) pairs names ignoring case. ``match='exact'`` (A2)
    reproduces the text loader: a target name not present with the same case becomes NULL,
    even when a column differing only in case exists. ``skip`` names a generated column of
    the target (any case) that is left out (A5). With ``cast`` every column is converted to
    the target type with ``try_cast`` (A6); count failures with :func:`cast_failures`.
    ``on_error='warn'`` returns the input unchanged when alignment itself fails (A7).
    """
    try:
        names = _names(target)
        types = _types(target)
        skip_l = skip.lower() if skip else None
        by_lower: dict[str, str] = {}
        for c in df.columns:
            by_lower.setdefault(c.lower(), c)
        exprs = []
        for t in names:
            if skip_l and t.lower() == skip_l:
                continue
            if match == "exact":
                src = t if t in df.columns else None
            else:
                src = by_lower.get(t.lower())
            if src is None:
                e = F.lit(None).cast(types.get(t, T.StringType()) if cast else T.StringType())
            else:
                e = ident(src)
                if cast and t in types:
                    e = e.try_cast(types[t])
            exprs.append(e.alias(t))
        return df.select(*exprs)
    except Exception as exc:  # noqa: BLE001 - policy switch
        if on_error == "warn":
            log.warning("alignment skipped: %s", exc)
            return df
        raise


def missing_columns(df: DataFrame, target, skip: str | None = None) -> list[str]:
    """Target columns without a (case-insensitive) source column (A4 notice list)."""
    have = {c.lower() for c in df.columns}
    skip_l = skip.lower() if skip else None
    return [t for t in _names(target) if t.lower() not in have and t.lower() != skip_l]


def unknown_columns(df: DataFrame, target) -> list[str]:
    """Frame columns the target does not have (checked before any write, trap T6)."""
    have = {t.lower() for t in _names(target)}
    return [c for c in df.columns if c.lower() not in have]


def failure_counts(df: DataFrame, target) -> list[tuple[str, Column]]:
    """Per target column that ``df`` has, the aggregate that counts the values present which
    ``try_cast`` turns NULL."""
    types = _types(target)
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for t, dt in types.items():
        src = by_lower.get(t.lower())
        if src is not None:
            c = ident(src)
            out.append((t, F.count_if(c.isNotNull() & c.try_cast(dt).isNull())))
    return out


def cast_failures(df: DataFrame, target) -> DataFrame:
    """One row: per target column, values present in ``df`` that ``try_cast`` turned NULL."""
    aggs = [n.alias(t) for t, n in failure_counts(df, target)]
    return df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
