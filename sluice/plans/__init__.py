"""User entry points: composite intake plans built from sources, operators and sinks.

Submodules: ``text`` (C1, C2), ``headed`` (C3–C5, C7), ``copy`` (C6), ``load`` (K6, S7),
``jobs`` (whole jobs).
"""

from .copy import copy_table, prepare_copy
from .headed import ingest, ingest_csv, ingest_sheets
from .jobs import run_report_job, run_text_job
from .load import load_main_and_audit, require_rows
from .text import ingest_text, parse_text

__all__ = ["copy_table", "prepare_copy", "ingest", "ingest_csv", "ingest_sheets",
           "run_report_job", "run_text_job", "load_main_and_audit", "require_rows",
           "ingest_text", "parse_text"]
