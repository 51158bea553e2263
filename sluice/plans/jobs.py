"""Whole intake jobs in one call: read every inbound file, load, report, move files.

These mirror the reference's job entry points (text, spreadsheet, CSV), but one call covers
all files of all cycles in one set of Spark jobs instead of one job per file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import PIPELINE_FAILURE, IntakeError
from ..operators.report import (file_disposition, input_files, move_by_outcome, run_report,
                                with_status)
from ..sinks.tables import staged
from ..sources.files import split_existing
from .headed import ingest_csv, ingest_sheets
from .load import load_main_and_audit
from .text import parse_text


@dataclass
class JobResult:
    outcomes: DataFrame    # per file: path, filename, status, reason, n_rows, payload
    report: DataFrame      # one row: n_units, n_failed
    moves: DataFrame | None


def _finish(spark, inputs, data, detected, missing, fail_on_no_rows, processed, error,
            errors=None):
    outcomes = file_disposition(spark, inputs, data, detected, missing,
                                fail_on_no_rows=fail_on_no_rows, errors=errors)
    outcomes = outcomes.checkpoint(eager=True)
    moves = move_by_outcome(spark, outcomes, processed, error) if processed and error else None
    return JobResult(outcomes, run_report(outcomes), moves)


def _none(spark):
    return spark.createDataFrame([], "_file string")


def _failed(spark, found, missing, exc, processed, error):
    """Outcomes of a run whose load failed: every input file failed with its status."""
    status = exc.status if isinstance(exc, IntakeError) else PIPELINE_FAILURE
    reason = exc.reason if isinstance(exc, IntakeError) else f"{type(exc).__name__}: {exc}"
    files = input_files(spark, found)
    errors = files.select(F.col("path").alias("_file"), F.lit(reason).alias("reason"))
    outcomes = file_disposition(spark, files, _none(spark), None, missing, errors=errors)
    outcomes = with_status(outcomes, PIPELINE_FAILURE, status).checkpoint(eager=True)
    moves = move_by_outcome(spark, outcomes, processed, error) if processed and error else None
    return JobResult(outcomes, run_report(outcomes), moves)


def run_text_job(spark: SparkSession, inputs, expected_columns, target_table: str,
                 audit_path: str | None = None, processed: str | None = None,
                 error: str | None = None, row_number_label: str | None = None,
                 match: str = "insensitive", on_cast: str = "raise", on_schema: str = "raise",
                 **text_options) -> JobResult:
    """C1/C2 for a whole inbound set: parse, truncate-load the main table, replace the
    audit's cycles, then record and act on each file's outcome. A failed load is an outcome
    of every file (``run_gate`` turns outcomes into an error)."""
    found, missing = split_existing(spark, inputs)
    if not found:
        return _finish(spark, [], _none(spark), None, missing, False, processed, error)
    try:
        rows = parse_text(spark, found, expected_columns, **text_options)
        with staged(rows) as shared:     # one computation for main, audit and outcomes
            load_main_and_audit(shared, target_table, audit_path, row_label=row_number_label,
                                stage=False, match=match, on_cast=on_cast,
                                on_schema=on_schema)
            return _finish(spark, input_files(spark, found), shared, None, missing, False,
                           processed, error)
    except Exception as exc:  # noqa: BLE001 - recorded per file
        return _failed(spark, found, missing, exc, processed, error)


def run_report_job(spark: SparkSession, inputs, target_headers, target_table: str,
                   audit_path: str | None = None, processed: str | None = None,
                   error: str | None = None, kind: str = "csv",
                   row_number_label: str | None = None, on_cast: str = "raise",
                   on_schema: str = "raise", **options) -> JobResult:
    """C3/C5 for a whole inbound set of reports (``kind`` ``csv`` or ``xlsx``). A workbook that
    cannot be parsed fails alone; a failed load is an outcome of every file."""
    found, missing = split_existing(spark, inputs)
    if not found:
        return _finish(spark, [], _none(spark), None, missing, False, processed, error)
    try:
        if kind == "xlsx":
            res = ingest_sheets(spark, found, target_headers, **options)
            fail_on_no_rows = True          # a workbook also fails when no data row remains
        else:
            res = ingest_csv(spark, found, target_headers, **options)
            fail_on_no_rows = False         # a CSV report fails only when no header matched
        with staged(res.data) as shared:   # one computation for main, audit and outcomes
            load_main_and_audit(shared, target_table, audit_path, row_label=row_number_label,
                                stage=False, on_cast=on_cast, on_schema=on_schema)
            return _finish(spark, input_files(spark, found), shared, res.detected, missing,
                           fail_on_no_rows, processed, error, res.errors)
    except Exception as exc:  # noqa: BLE001 - recorded per file
        return _failed(spark, found, missing, exc, processed, error)
