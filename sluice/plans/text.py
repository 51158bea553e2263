"""Delimited-text intake (C1 / C2): scan → number → split → expand → filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import MISSING_PARAMETERS, IntakeError
from ..operators.delimited import (DEFAULT_DELIMITER, DEFAULT_LABEL, ALL_RECORDS,
                                   expand_fields, field_names, record_type)
from ..operators.stamp import FILE_COL, NAME_COL, ROW_COL, stamp_rows
from ..sources.text import read_lines


def parse_text(spark: SparkSession, paths, expected_columns, delimiter_regex: str = DEFAULT_DELIMITER,
               filter_record_type: str = ALL_RECORDS, col_label: str = DEFAULT_LABEL,
               on_missing: str = "raise") -> DataFrame:
    """``{label}1..N`` (trimmed, blank → NULL), ``filename``, ``_file``, ``_temp_row_num``.

    Numbers are assigned per file before the record filter, so they keep gaps.
    """
    if not expected_columns:
        raise IntakeError(MISSING_PARAMETERS, "expected_columns is required", str(paths))
    n = int(expected_columns)
    stamped = stamp_rows(read_lines(spark, paths, on_missing=on_missing))
    expanded = expand_fields(stamped, n, delimiter_regex, col_label,
                             keep=[NAME_COL, FILE_COL, ROW_COL])
    kept = record_type(expanded, filter_record_type, col_label)
    return kept.select(*field_names(n, col_label), NAME_COL, FILE_COL, ROW_COL)


def ingest_text(spark: SparkSession, paths, expected_columns, target=None,
                delimiter_regex: str = DEFAULT_DELIMITER, filter_record_type: str = ALL_RECORDS,
                col_label: str = DEFAULT_LABEL, row_number_label: str | None = None,
                audit_target=None, file_cols: bool = False, match: str = "exact"):
    """Returns ``(main, audit)`` frames ready for the sinks.

    ``main`` is aligned to ``target`` (names of the target table; exact-case matching like
    the text loader unless ``match='insensitive'``), the generated ``row_number_label``
    column skipped; with ``file_cols`` it carries ``filename`` and ``dateread`` (C2).
    ``audit`` (only with ``audit_target``) adds number, cycle, file, UUIDv7 and time,
    aligned case-insensitively to the audit table.
    """
    from ..operators.align import align
    from ..operators.audit import audit_columns, file_columns, main_columns

    parsed = parse_text(spark, paths, expected_columns, delimiter_regex, filter_record_type,
                        col_label)
    main = file_columns(parsed) if file_cols else main_columns(parsed)
    if target is not None:
        main = align(main, target, match=match, skip=row_number_label)
    audit = None
    if audit_target is not None:
        audit = align(audit_columns(parsed), audit_target)
    return main, audit
