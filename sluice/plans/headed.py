"""Report intake with fuzzy headers (C3 spreadsheets, C5 CSV) and the flat mode (C4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MISSING_PARAMETERS, IntakeError
from ..functions.lineage import base_name
from ..functions.text import ident
from ..operators import headers as H
from ..operators.stamp import FILE_COL, NAME_COL, ROW_COL, stamp_rows
from ..session import scratch_path, shared_root
from ..sources.csv import DEFAULT_SEP, CsvPrePass, pre_pass, read_csv_grid

FLAT_LABEL = "column"


def _name(df: DataFrame):
    """The decoded file name: carried from the scan when present (computed once per file)."""
    return F.col(NAME_COL) if NAME_COL in df.columns else base_name(FILE_COL).alias(NAME_COL)


@dataclass
class HeadedResult:
    data: DataFrame       # target columns, filename, _file, _temp_row_num
    detected: DataFrame   # one row per report: header_end, n, mapping, tidx (checkpointed)
    targets: list[str]
    errors: DataFrame | None = None   # workbooks that could not be parsed: _file, reason


def csv_grid(spark: SparkSession, paths, sep: str = DEFAULT_SEP, width: int | None = None,
             on_missing: str = "raise", known: CsvPrePass | None = None) -> DataFrame:
    """``(cells, _file, filename, _temp_row_num)`` for every non-empty CSV line, numbered
    per file. ``known`` is a pre-pass over the same files; without it and without a width one
    is made here."""
    if known is None and width is None:
        known = pre_pass(spark, paths, sep, on_missing=on_missing)
    rows = read_csv_grid(spark, paths, sep=sep, width=known.width if known else width,
                         on_missing=on_missing)
    return stamp_rows(rows, offsets=known.offsets if known else None)


def detect(rows: DataFrame, targets: list[str], min_score: float = H.SCORE_SHARED,
           strict: bool = False) -> DataFrame:
    """Header detection per report from its first rows (or all of them), materialised in the
    shared checkpoint folder."""
    shared_root(rows.sparkSession)
    return H.detect_headers(H.sample_reports(rows), targets, min_score=min_score,
                            strict=strict).checkpoint(eager=True)


def clean_rows(grid: DataFrame, detected: DataFrame, footer_phrases=H.FOOTER_PHRASES) -> DataFrame:
    """Rows after the header block that are neither footers nor blank."""
    rows = H.skip_preamble(grid, detected)
    return rows.filter(~H.is_blank(F.col("cells")) & ~H.is_footer(F.col("cells"), footer_phrases))


def headed(grid: DataFrame, target_headers, footer_phrases=H.FOOTER_PHRASES,
           min_score: float = H.SCORE_SHARED, strict: bool = False,
           first_rows: DataFrame | None = None) -> HeadedResult:
    """Detect, clean and project every report of ``grid`` onto the target headers.

    ``first_rows`` are the rows to look for headers in where they are known without a scan of
    the grid. Defaults keep the reference's rules; ``footer_phrases`` (trap T9), ``min_score`` (T10)
    and ``strict`` (T5, T18) tighten them.
    """
    targets = H.parse_headers(target_headers or "")
    if not targets:
        raise IntakeError(MISSING_PARAMETERS, "target_headers is required")
    detected = detect(grid if first_rows is None else first_rows, targets, min_score, strict)
    data = H.project_mapped(clean_rows(grid, detected, footer_phrases), targets,
                            keep=(NAME_COL, FILE_COL, ROW_COL))
    data = data.select(*[ident(t) for t in targets], _name(data), FILE_COL, ROW_COL)
    return HeadedResult(data, detected, targets)


def flat(grid: DataFrame, label: str = FLAT_LABEL, width: int | None = None) -> DataFrame:
    """Positional ``column1..N`` with values untouched (no trim, no filter) (C4)."""
    if width is None:
        width = grid.agg(F.max(F.size("cells")).alias("w")).first()["w"] or 0
    cols = [F.get(F.col("cells"), i).alias(f"{label}{i + 1}") for i in range(int(width))]
    return grid.select(*cols, _name(grid), FILE_COL, ROW_COL)


def ingest_csv(spark: SparkSession, paths, target_headers, sep: str = DEFAULT_SEP,
               width: int | None = None, on_missing: str = "raise", **rules) -> HeadedResult:
    """Headerless CSV reports → detected headers → clean rows with file columns.

    The files are read twice in all: a joint pre-pass (row counts of splits, first rows, widest
    line) and the data pass.
    """
    known = pre_pass(spark, paths, sep, width, H.SAMPLE_ROWS, on_missing)
    return headed(csv_grid(spark, paths, sep, width, on_missing, known), target_headers,
                  first_rows=known.first_rows(H.SAMPLE_ROWS), **rules)


def sheets_scan(spark: SparkSession, paths, sheet=0,
                on_missing: str = "raise") -> tuple[DataFrame, DataFrame]:
    """The grid ``(cells, filename, _file, _temp_row_num)`` of one sheet per workbook and the
    ``(_file, reason)`` of workbooks that cannot be parsed, whose rows are left out.

    Parsing is Python work, so all rows are staged once as Parquet in the shared folder and
    the header pass, the data pass and the report read that.
    """
    from ..sources.workbook import ERROR_COL, scan_workbooks

    path = scratch_path(spark, "sheets")
    rows = scan_workbooks(spark, paths, sheet, on_missing)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    errors = rows.filter(F.col(ERROR_COL).isNotNull()).select(FILE_COL, F.col(ERROR_COL).alias("reason"))
    grid = rows.join(errors.select(FILE_COL), FILE_COL, "left_anti")
    return grid.select("cells", NAME_COL, FILE_COL, ROW_COL), errors


def sheets_grid(spark: SparkSession, paths, sheet=0, on_missing: str = "raise") -> DataFrame:
    """The grid of :func:`sheets_scan`."""
    return sheets_scan(spark, paths, sheet, on_missing)[0]


def ingest_sheets(spark: SparkSession, paths, target_headers=None, sheet=0,
                  on_missing: str = "raise", **rules):
    """C3 (headed, with ``target_headers``) or C4 (flat): returns a :class:`HeadedResult`
    or, in flat mode, the positional frame."""
    grid, errors = sheets_scan(spark, paths, sheet, on_missing)
    if target_headers:
        res = headed(grid, target_headers, **rules)
        res.errors = errors
        return res
    return flat(grid)


def ingest(spark: SparkSession, paths, kind: str | None = None, **options):
    """C7 router: ``TXT`` / ``TXT_NUMBERED`` (any case) → text intake; anything else →
    spreadsheet intake."""
    from .text import ingest_text

    if (kind or "").upper() in ("TXT", "TXT_NUMBERED"):
        return ingest_text(spark, paths, **options)
    return ingest_sheets(spark, paths, **options)
