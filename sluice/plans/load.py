"""Loading a prepared intake: cycle-coded names (S7), dual write (K6), empty guard (H6/G1)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import AUDIT_WRITE_ERROR, EMPTY_DATA, IntakeError
from ..sinks.cycles import commit, stage_cycles
from ..functions.lineage import CYCLE_PREFIX, base_name
from ..operators.stamp import FILE_COL
from ..sinks.tables import load_partitions, staged, target_schema, truncate_load


def cycle_file_name(file_name: str, code: str) -> str:
    """Replace the last two characters of the file stem by the cycle code (``x_01.txt``→``x_07.txt``)."""
    stem, ext = os.path.splitext(file_name)
    return stem[:-2] + code + ext


def cycle_table_name(table: str, code: str) -> str:
    """Replace the last two characters of the table name by the cycle code."""
    return table[:-2] + code


def cycle_inputs(folder: str, file_template: str, table_template: str, codes) -> list[tuple[str, str]]:
    """``(input path, target table)`` per cycle code; read them all with one multi-file job."""
    base = folder.rstrip("/")
    return [(f"{base}/{cycle_file_name(file_template, c)}", cycle_table_name(table_template, c))
            for c in codes]


def require_rows(df: DataFrame, path: str = "Unknown") -> None:
    """Raise ``empty_data`` when ``df`` has no row (one cheap ``isEmpty`` job)."""
    if df.isEmpty():
        raise IntakeError(EMPTY_DATA, "Fuzzy matcher failed or sheet is blank", path)


def load_main_and_audit(rows: DataFrame, target_table: str, audit_path: str | None = None,
                        row_label: str | None = None, audit_key="billcycle",
                        audit_target=None, stage: bool = True,
                        match: str = "insensitive", on_cast: str = "raise",
                        on_schema: str = "raise") -> dict[str, int]:
    """K6: from one computation of the cleaned ``rows`` (data columns, ``filename``,
    ``_file``, ``_temp_row_num``), truncate-and-load the main table and replace the audit's
    cycles in a versioned folder (:mod:`sluice.sinks.cycles`; read it with ``read_cycles``).
    ``row_label`` names the main table's row number (see
    :func:`sluice.operators.audit.main_columns`); ``match`` and ``on_cast`` are those of
    :func:`sluice.operators.align.align` and the sink. ``on_schema="warn"`` loads without
    alignment where the main table's schema cannot be read (A7). Returns rejected values per
    column.

    ``rows`` is written once to the shared folder for both loads (pass ``stage=False`` when the
    caller already holds it). The audit rows are written, then the main table is loaded, then
    the audit is committed: whatever fails before that leaves the audit as it was, and a main
    load that is rejected leaves both.
    """
    from contextlib import nullcontext
    from ..operators.align import align
    from ..operators.audit import audit_columns, main_columns

    spark = rows.sparkSession
    with (staged(rows) if stage else nullcontext(rows)) as shared:
        main = main_columns(shared, row_label)
        schema = target_schema(spark, target_table, on_schema)
        if schema is not None:
            main = align(main, schema, match=match)
        load = None
        if audit_path:
            audit = audit_columns(shared)
            if audit_target is not None:
                audit = align(audit, audit_target)
            load = _audit(lambda: stage_cycles(audit, audit_path, audit_key), audit_path)
        rejects = truncate_load(main, target_table, on_cast=on_cast, on_schema=on_schema)
        if load:
            _audit(lambda: commit(spark, load), audit_path)
    return rejects


def _audit(step, path: str):
    try:
        return step()
    except Exception as exc:
        raise IntakeError(AUDIT_WRITE_ERROR, str(exc), path) from exc


def load_cycle_tables(rows: DataFrame, table_template: str, codes, row_label: str | None = None,
                      on_cast: str = "raise", location: str | None = None) -> list[str]:
    """From one computation of ``rows`` over the files of all cycles, load every
    cycle's rows into its own table (``table_template`` with the cycle code as its last two
    characters). Returns the tables.

    One partitioned write holds the rows of all cycles, whatever their number; then each table
    (external, unpartitioned, all of one definition) is pointed at the folder of its cycle: a
    catalog operation and no job. Rejected values and unknown columns raise before any table
    is touched. Other tables are each loaded from their folder. The write goes below ``location`` (next to the first table by default); the load before
    stays there for its readers, older ones go. A cycle without rows leaves its table empty.
    """
    from ..functions.lineage import bill_cycle
    from ..operators.audit import main_columns

    spark = rows.sparkSession
    tables = {cycle_table_name(table_template, code): CYCLE_PREFIX + code for code in codes}
    if not tables:
        return []
    cycle = "_cycle"
    name = F.col("filename") if "filename" in rows.columns else base_name(FILE_COL)
    mine = rows.withColumn(cycle, bill_cycle(name)).filter(F.col(cycle).isin(*tables.values()))
    if row_label:   # numbered by a pass over the files' last rows and one over the rows
        with staged(mine) as shared:
            load_partitions(main_columns(shared, row_label, within=cycle), cycle, tables,
                            on_cast, location)
    else:
        load_partitions(main_columns(mine, within=cycle), cycle, tables, on_cast, location)
    return list(tables)
