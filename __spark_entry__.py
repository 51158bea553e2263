"""

Every query reads the given tables (or files Spark writes from them, below the shared
scratch folder) in full. Column names and types are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import fixtures as fx
from sluice.functions.lineage import bill_cycle, is_uuid7, uuid7
from sluice.functions.text import norm_text
from sluice.operators import headers as H
from sluice.operators.align import align
from sluice.operators.audit import audit_columns, file_columns
from sluice.operators.clean import max_lengths, stringify, strip_zero_fraction
from sluice.operators.delimited import expand_fields, record_type
from sluice.operators.report import (file_disposition, input_files, move_by_outcome,
                                     run_failures, run_report)
from sluice.operators.stamp import ROW_COL, stamp_rows
from sluice.plans import headed as HP
from sluice.plans.copy import copy_table
from sluice.plans.headed import ingest
from sluice.plans.jobs import run_report_job
from sluice.plans.load import cycle_table_name, load_cycle_tables, load_main_and_audit
from sluice.plans.text import ingest_text, parse_text
from sluice.session import scratch_path
from sluice.sinks.cycles import commit_cycles, read_cycles, stage_cycles
from sluice.sinks.tables import append, backup_csv, truncate_load
from sluice.sources.files import split_existing
from sluice.sources.text import read_lines
from sluice.sources.workbook import read_workbooks
from sluice.streaming.inbound import stream_inbound, text_audit_rows

SMOKE_DIR = "/root/testdata/sf0.001"
# Edge values appended to the documents for norm_text: NULL, the none word, blanks, and
# Unicode / control whitespace.
NORM_EDGES = [(-1, None), (-2, "None"), (-3, "   "), (-4, " nOnE "),
              (-5, "a\u00a0\u2003b\x1c\tc "), (-6, "\u3000x\u2028 y\x85")]
TEXT_COLUMNS = 7
COLS7 = [f"column{i}" for i in range(1, TEXT_COLUMNS + 1)]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the delimited-text pipeline over order files written from sf0.001."""
    return q_text_pipeline(spark, SMOKE_DIR)


# ---------------------------------------------------------------------------------------
# text keys (fixture L)
# ---------------------------------------------------------------------------------------
def _lines(spark, sf_dir):
    return fx.order_lines(fx.table(spark, sf_dir, "orders"))


def q_text_expand(spark, sf_dir):
    """Regex split, fixed-width expansion (NULL past the end), trim."""
    return expand_fields(_lines(spark, sf_dir), TEXT_COLUMNS, null_blank=False,
                         keep=["o_orderkey"])


def q_text_blank_null(spark, sf_dir):
    """Blank fields become NULL after trimming."""
    return expand_fields(_lines(spark, sf_dir), TEXT_COLUMNS, keep=["o_orderkey"])


def q_record_filter(spark, sf_dir):
    """record-type filter on the first field."""
    return record_type(q_text_blank_null(spark, sf_dir), "H")


def _order_files(spark, sf_dir):
    folder = scratch_path(spark, "order-lines")
    fx.write_order_files(spark, sf_dir, folder)
    return folder


def q_text_pipeline(spark, sf_dir):
    """Text files → numbered per file → expanded → record filter."""
    parsed = parse_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS,
                        filter_record_type="D")
    return parsed.select(*COLS7, "filename", F.col(ROW_COL).alias("rownumber"))


def q_row_stamp(spark, sf_dir):
    """Dense 1-based numbers in file order over many files."""
    folder = scratch_path(spark, "event-lines")
    fx.write_event_files(spark, sf_dir, folder)
    stamped = stamp_rows(read_lines(spark, folder))
    return stamped.select(F.regexp_extract("_file", r"([^/]*)$", 1).alias("filename"),
                          F.col(ROW_COL).alias("rownumber"), "value")


def q_text_scan(spark, sf_dir):
    """One row per line, blank lines kept (line counts per language)."""
    folder = scratch_path(spark, "doc-lines")
    fx.write_document_files(spark, sf_dir, folder)
    lines = read_lines(spark, folder, positioned=False)
    lang = F.regexp_extract(F.col("_metadata.file_name"), r"^docs_([^_]+)_", 1)
    return (lines.select(lang.alias("lang"), "value")
            .groupBy("lang")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_if(F.col("value") == "").alias("n_blank"),
                 F.sum(F.length("value")).cast("long").alias("n_chars")))


def q_norm_text(spark, sf_dir):
    """Whitespace / none normaliser over whole document texts."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    edge = spark.createDataFrame(NORM_EDGES, "doc_id long, text string")
    return docs.unionByName(edge).select("doc_id", norm_text("text").alias("norm"))


def q_bill_cycle(spark, sf_dir):
    """Bill cycle from the file stem."""
    orders = fx.table(spark, sf_dir, "orders")
    name = fx.cycle_file_name(F.col("o_orderstatus"), F.col("o_orderkey"))
    return orders.select("o_orderkey", name.alias("filename"),
                         bill_cycle(name).alias("billcycle"))


def q_uuid7(spark, sf_dir):
    """UUIDv7 ids are valid and distinct."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", uuid7().alias("sequencialid"))
    return ev.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(is_uuid7("sequencialid")).alias("n_valid"),
                  F.count_distinct("sequencialid").alias("n_distinct"))


# ---------------------------------------------------------------------------------------
# report keys (fixture R: one CSV report per nation and key range)
# ---------------------------------------------------------------------------------------
def _sheet(col="_file"):
    return F.regexp_extract(F.col(col), r"([^/]*)\.[^./]*$", 1).alias("sheet")


def _cells6(col="cells"):
    return [F.get(F.col(col), i).alias(f"c{i}") for i in range(fx.GRID_WIDTH)]


def _report_grid(spark, sf_dir, blank_sheet=None):
    folder = scratch_path(spark, "reports-csv")
    fx.write_report_csv(spark, sf_dir, folder, blank_sheet)
    return HP.csv_grid(spark, folder, width=fx.GRID_WIDTH)


def _targets():
    return H.parse_headers(fx.TARGET_HEADERS)


def q_csv_scan(spark, sf_dir):
    """Headerless CSV reports as positional cells, numbered per file."""
    g = _report_grid(spark, sf_dir)
    return g.select(_sheet(), F.col(ROW_COL).alias("rownumber"), *_cells6())


def _windows(spark, sf_dir):
    return H.header_windows(H.sample_reports(_report_grid(spark, sf_dir)))


def q_header_windows(spark, sf_dir):
    """H1 / O2: candidate header blocks of each report's first 50 rows."""
    w = _windows(spark, sf_dir)
    return (w.select(_sheet(), "start", "height", F.posexplode("cols").alias("c", "text"))
            .filter(F.col("text") != "")
            .select("sheet", F.col("start").cast("long").alias("start"),
                    F.col("height").cast("long").alias("height"),
                    F.col("c").cast("long").alias("c"), "text"))


def q_header_scores(spark, sf_dir):
    """Pair scores of block columns against the targets."""
    sc = H.header_scores(_windows(spark, sf_dir), _targets())
    return sc.select(_sheet(), F.col("start").cast("long").alias("start"),
                     F.col("height").cast("long").alias("height"),
                     F.inline("cands")).select(
        "sheet", "start", "height", F.col("c").cast("long").alias("c"),
        F.col("th").alias("target"), F.col("score").cast("double").alias("score"))


def q_header_assign(spark, sf_dir):
    """H3: greedy one-to-one assignment per block."""
    a = H.assign_headers(H.header_scores(_windows(spark, sf_dir), _targets()))
    return a.select(_sheet(), F.col("start").cast("long").alias("start"),
                    F.col("height").cast("long").alias("height"),
                    F.inline("mapping")).select(
        "sheet", "start", "height", F.col("c").cast("long").alias("c"),
        F.col("th").alias("target"))


def q_header_detect(spark, sf_dir):
    """H4: best header block per report."""
    d = HP.detect(_report_grid(spark, sf_dir), _targets())
    return d.filter(F.col("n") > 0).select(
        _sheet(), F.col("header_end").cast("long").alias("header_end"),
        F.col("n").cast("long").alias("n"), H.mapping_text(F.col("mapping")).alias("mapping"))


def _after_header(spark, sf_dir):
    g = _report_grid(spark, sf_dir)
    return H.skip_preamble(g, HP.detect(g, _targets()))


def _grid_out(df):
    return df.select(_sheet(), F.col(ROW_COL).alias("rownumber"), *_cells6())


def q_preamble_skip(spark, sf_dir):
    """Rows after each report's header block."""
    return _grid_out(_after_header(spark, sf_dir))


def q_footer_filter(spark, sf_dir):
    """Footer rows removed."""
    return _grid_out(H.drop_footers(_after_header(spark, sf_dir)))


def q_blank_row_filter(spark, sf_dir):
    """blank rows removed."""
    return _grid_out(H.drop_blank_rows(_after_header(spark, sf_dir)))


def q_headed_project(spark, sf_dir):
    """Mapped cells projected onto the target headers."""
    res = HP.headed(_report_grid(spark, sf_dir), fx.TARGET_HEADERS)
    return res.data.select(_sheet(), F.col(ROW_COL).alias("rownumber"), *res.targets)


def q_flat_rename(spark, sf_dir):
    """P5 / C4: flat positional column1..N."""
    flat = HP.flat(_report_grid(spark, sf_dir))
    return flat.select(_sheet(), F.col(ROW_COL).alias("rownumber"),
                       *[f"column{i}" for i in range(1, fx.GRID_WIDTH + 1)])


# ---------------------------------------------------------------------------------------
# alignment, sanitising, sinks (tables customer / part / supplier / nation)
# ---------------------------------------------------------------------------------------
T_CUSTOMER = "C_CUSTKEY bigint, C_MKTSEGMENT string, C_NAME string, EXTRA_COL string, ROW_ID bigint"
T_EXACT = "c_custkey bigint, C_NAME string, c_mktsegment string, extra string, row_id bigint"
T_TYPED = "C_CUSTKEY bigint, C_ACCTBAL double, C_NATIONKEY int, C_NAME string, C_MKTSEGMENT int"
T_PART = ("P_PARTKEY string, P_NAME string, P_RETAILPRICE string, P_SIZE string, "
          "P_CONTAINER string, P_BRAND string")


def _schema(ddl):
    from pyspark.sql.types import _parse_datatype_string
    return _parse_datatype_string(ddl)


def q_align_case_insensitive(spark, sf_dir):
    """Case-insensitive alignment, missing NULL, extras dropped."""
    return align(fx.table(spark, sf_dir, "customer"), _schema(T_CUSTOMER))


def q_align_exact(spark, sf_dir):
    """A2 / A5: exact-case alignment (case trap kept) with a skipped column."""
    return align(fx.table(spark, sf_dir, "customer"), _schema(T_EXACT), match="exact",
                 skip="ROW_ID")


def q_align_skip(spark, sf_dir):
    """A5: generated row-number column skipped."""
    return align(fx.table(spark, sf_dir, "customer"), _schema(T_CUSTOMER), skip="row_id")


def q_align_typed(spark, sf_dir):
    """Conversion to the target types with try_cast."""
    return align(stringify(fx.table(spark, sf_dir, "customer")), _schema(T_TYPED), cast=True)


def _part2(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    return p.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(18,2)"))


def q_stringify(spark, sf_dir):
    """Every column to trimmed string."""
    return stringify(_part2(spark, sf_dir))


def q_strip_zero_fraction(spark, sf_dir):
    """Zero-only decimal tail removed."""
    return strip_zero_fraction(stringify(_part2(spark, sf_dir)), ["p_retailprice"])


def q_max_lengths(spark, sf_dir):
    """Longest value per column in one aggregation."""
    c = fx.table(spark, sf_dir, "customer")
    return max_lengths(c.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)")))


def q_csv_backup(spark, sf_dir):
    """K4: CSV backup with header, read back."""
    s = fx.table(spark, sf_dir, "supplier")
    s = stringify(s.withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(18,2)")))
    path = scratch_path(spark, "supplier-backup")
    backup_csv(s, path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name",
                       F.col("s_nationkey").cast("int").alias("s_nationkey"),
                       F.col("s_acctbal").cast("double").alias("s_acctbal"))


def _scratch_table(spark, name, ddl):
    import uuid
    tname = f"{name}_{uuid.uuid4().hex[:10]}"
    loc = scratch_path(spark, "tables") + "/" + tname
    spark.sql(f"CREATE TABLE {tname} ({ddl}) USING parquet LOCATION '{loc}'")
    return tname


def q_truncate_load(spark, sf_dir):
    """K1 / K5: truncate-and-load keeps the table, replaces all rows."""
    t = _scratch_table(spark, "nation_copy", "N_NATIONKEY int, N_NAME string, N_REGIONKEY int")
    region = fx.table(spark, sf_dir, "region")
    truncate_load(region.select(F.col("r_regionkey").alias("n_nationkey"),
                                F.col("r_name").alias("n_name")), t)
    truncate_load(fx.table(spark, sf_dir, "nation"), t)
    return spark.table(t)


def q_append_typed(spark, sf_dir):
    """Strings appended twice to a typed table, converted to its types."""
    t = _scratch_table(spark, "customer_typed", "C_CUSTKEY bigint, C_NAME string, C_NATIONKEY int")
    rows = stringify(fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"))
    append(rows, t)
    append(rows.withColumn("c_name", F.lower("c_name")), t)
    return spark.table(t)


def q_load_rejects(spark, sf_dir):
    """Values that do not fit the target's types, counted per column."""
    t = _scratch_table(spark, "orders_typed", "O_ORDERKEY bigint, O_CUSTKEY int, O_TOTALPRICE double")
    o = fx.table(spark, sf_dir, "orders")
    bad = F.when(F.col("o_orderkey") % 7 == 0, "1,200").otherwise(F.col("o_custkey").cast("string"))
    rows = o.select("o_orderkey", bad.alias("o_custkey"),
                    F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise("1.5").alias("o_totalprice"))
    n = truncate_load(rows, t, on_cast="null")
    loaded = spark.table(t).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in n])
    return loaded.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(k).cast("long").alias("rejects"),
        F.col(c).alias("nulls_loaded")) for c, k in sorted(n.items())])))


def q_load_without_schema(spark, sf_dir):
    """The main table's schema cannot be read, so its rows are loaded as they are; the
    audit is committed as ever."""
    where = scratch_path(spark, "unread")
    name = "unread_" + where.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{where}'")
    t = f"{name}.orders"         # not there: created by the load
    path = scratch_path(spark, "unread-audit")
    rows = parse_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS)
    load_main_and_audit(rows, t, path, on_schema="warn")
    main = spark.table(t).select(F.lit("main").alias("part"), *COLS7)
    return main.union(read_cycles(spark, path).select(F.lit("audit"), *COLS7))


def q_table_copy(spark, sf_dir):
    """Align, sanitise, length audit and load a table copy."""
    t = _scratch_table(spark, "part_copy", T_PART)
    copy_table(_part2(spark, sf_dir), t, rate_columns=["p_retailprice"])
    return spark.table(t)


# ---------------------------------------------------------------------------------------
# audit, cycles, metadata (fixtures L + F)
# ---------------------------------------------------------------------------------------
def _audit_rows(spark, sf_dir):
    _, audit = ingest_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS,
                           audit_target=COLS7 + ["rownumber", "billcycle", "filename",
                                                 "sequencialid", "dateprocessed"])
    return audit


def q_audit_enrich(spark, sf_dir):
    """Audit columns aligned to the audit table."""
    a = _audit_rows(spark, sf_dir)
    return a.select(*COLS7, "rownumber", "billcycle", "filename",
                    is_uuid7("sequencialid").alias("id_valid"),
                    F.col("dateprocessed").isNotNull().alias("has_time"))


def q_file_columns(spark, sf_dir):
    """Filename and dateread on the main rows."""
    main, _ = ingest_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS, file_cols=True)
    return main.select(*COLS7, "filename", F.col("dateread").isNotNull().alias("has_dateread"))


def q_multi_cycle_load(spark, sf_dir):
    """Every cycle file in one job, cycle per file."""
    a = _audit_rows(spark, sf_dir)
    return a.select("billcycle", "filename", "rownumber", *COLS7)


def q_main_audit_load(spark, sf_dir):
    """K6 / O1 / O3 / A5: one computation loads main (rows numbered over all files) and audit."""
    ddl = ", ".join(f"COLUMN{i} string" for i in range(1, TEXT_COLUMNS + 1))
    t = _scratch_table(spark, "orders_main", f"{ddl}, ROW_ID bigint")
    path = scratch_path(spark, "orders-audit")
    rows = parse_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS)
    load_main_and_audit(rows, t, path, row_label="row_id")
    main = spark.table(t).select(F.lit("main").alias("part"), F.lit(None).cast("string").alias("filename"),
                                 F.col("ROW_ID").alias("number"), *COLS7)
    audit = read_cycles(spark, path).select(F.lit("audit").alias("part"), "filename",
                                            F.col("rownumber").alias("number"), *COLS7)
    return main.union(audit)


def q_cycle_tables(spark, sf_dir):
    """Every cycle's files into the cycle's own table, in one job."""
    codes = [f"{c:02d}" for c in range(1, 12)]
    base = _scratch_table(spark, "cycle", "COLUMN1 string") + "_00"
    ddl = ", ".join(f"COLUMN{i} string" for i in range(1, TEXT_COLUMNS + 1))
    for c in codes:
        name = cycle_table_name(base, c)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet "
                  f"LOCATION '{scratch_path(spark, 'cycle-table')}'")
    rows = parse_text(spark, _order_files(spark, sf_dir), TEXT_COLUMNS)
    out = None
    for c, name in zip(codes, load_cycle_tables(rows, base, codes)):
        part = spark.table(name).select(F.lit("BC" + c).alias("cycle_table"), *COLS7)
        out = part if out is None else out.union(part)
    return out


def q_router(spark, sf_dir):
    """The text kind goes to the text intake."""
    return ingest(spark, _order_files(spark, sf_dir), kind="txt_numbered",
                  expected_columns=TEXT_COLUMNS)[0]


def q_cycle_replace(spark, sf_dir):
    """K3: replace two cycles by a second committed load, keep the others; a third load that is
    written and never committed changes nothing."""
    a = _audit_rows(spark, sf_dir).drop("sequencialid", "dateprocessed")
    path = scratch_path(spark, "audit-by-cycle")
    commit_cycles(a, path)
    changed = (read_cycles(spark, path).filter(F.col("billcycle").isin("BC01", "BC02"))
               .withColumn("column5", F.lower("column5")))
    commit_cycles(changed, path)
    stage_cycles(changed.withColumn("billcycle", F.lit("BC03")), path)
    return read_cycles(spark, path).select(*COLS7, "rownumber", "billcycle", "filename")


# ---------------------------------------------------------------------------------------
# workbooks and full report pipelines
# ---------------------------------------------------------------------------------------
def _report_books(spark, sf_dir, blank_sheet=None):
    folder = scratch_path(spark, "reports-xlsx")
    fx.write_report_xlsx(spark, sf_dir, folder, blank_sheet)
    return folder


def q_xlsx_scan(spark, sf_dir):
    """S3: workbook cells from A1, numbered while parsed."""
    g = read_workbooks(spark, _report_books(spark, sf_dir))
    return g.select("sheet", F.col(ROW_COL).alias("rownumber"), *_cells6())


def q_sheets_flat(spark, sf_dir):
    """Workbooks routed to the flat mode, cells untouched."""
    flat = ingest(spark, _report_books(spark, sf_dir), kind="xlsx")
    return flat.select(_sheet(), F.col(ROW_COL).alias("rownumber"),
                       *[f"column{i}" for i in range(1, fx.GRID_WIDTH + 1)])


AUDIT_REPORT = ["Account No", "Customer Name", "Account Balance", "Market Segment",
                "rownumber", "billcycle", "filename", "sequencialid", "dateprocessed"]


def q_headed_pipeline(spark, sf_dir):
    """Spreadsheet reports → headers → clean rows → audit."""
    res = HP.ingest_sheets(spark, _report_books(spark, sf_dir), fx.TARGET_HEADERS)
    audit = align(audit_columns(res.data), AUDIT_REPORT)
    return audit.select(*res.targets, "rownumber", "billcycle", "filename",
                        is_uuid7("sequencialid").alias("id_valid"))


T_REPORT = ["market segment", "account no", "customer name", "filename", "dateread",
            "row_id", "account balance"]


def q_csv_pipeline(spark, sf_dir):
    """CSV reports → headers → clean rows → file columns → alignment."""
    folder = scratch_path(spark, "reports-csv")
    fx.write_report_csv(spark, sf_dir, folder)
    res = HP.ingest_csv(spark, folder, fx.TARGET_HEADERS, width=fx.GRID_WIDTH)
    main = align(file_columns(res.data), T_REPORT, skip="ROW_ID")
    return main.withColumn("dateread", F.col("dateread").isNotNull())


def _blanked():
    return F.col("n") % 8 == 3         # three nations' reports are emptied
MISSING_REPORT = "report_99_9.csv"


def _dispositions(spark, sf_dir):
    folder = scratch_path(spark, "reports-csv")
    fx.write_report_csv(spark, sf_dir, folder, _blanked())
    inputs = [folder + "/*.csv", folder + "/" + MISSING_REPORT]
    found, missing = split_existing(spark, inputs)
    res = HP.ingest_csv(spark, found, fx.TARGET_HEADERS, width=fx.GRID_WIDTH)
    return file_disposition(spark, input_files(spark, found), res.data, res.detected, missing,
                            fail_on_no_rows=False)


def q_file_disposition(spark, sf_dir):
    """Per-file outcome incl. empty and missing inputs; the files move to the
    processed or error folder by it."""
    d = _dispositions(spark, sf_dir).checkpoint(eager=True)    # before the files move
    root = scratch_path(spark, "reports-moved")
    moves = move_by_outcome(spark, d, root + "/processed", root + "/error")
    d = d.join(moves.select("path", F.regexp_extract("moved_to", r"([^/]*/[^/]*)$", 1)
                            .alias("moved_to")), "path", "left")
    part = lambda k: F.get_json_object("payload", f"$.{k}")
    return d.select("filename", "status", "reason", "n_rows", part("status").alias("payload_status"),
                    part("reason").alias("payload_reason"),
                    F.regexp_extract(part("failed_file_path"), r"([^/]*)$", 1).alias("payload_file"),
                    "moved_to")


def q_workbook_failures(spark, sf_dir):
    """One corrupt workbook among the reports fails alone."""
    root = scratch_path(spark, "reports-bad")
    fx.write_report_xlsx(spark, sf_dir, root)
    fx.write_bytes(root + "/broken_99.xlsx", b"not a workbook")
    t = _scratch_table(spark, "report_main", "`Account No` string, `Customer Name` string, "
                       "`Account Balance` string, `Market Segment` string, ROW_ID bigint")
    res = run_report_job(spark, [root + "/*.xlsx"], fx.TARGET_HEADERS, t, kind="xlsx",
                         row_number_label="row_id")
    return res.outcomes.select("filename", "status", "n_rows")


def q_run_report(spark, sf_dir):
    """Consolidated run report."""
    return run_report(_dispositions(spark, sf_dir))


def q_run_failures(spark, sf_dir):
    """The failed units of a run."""
    return run_failures(_dispositions(spark, sf_dir))


def q_inbound_stream(spark, sf_dir):
    """Inbound-folder stream, per micro-batch replace by cycle and file; files of two cycles
    are sent again, changed, under the same names, and a third run finds nothing."""
    root = scratch_path(spark, "inbound-stream")

    def intake():
        stream_inbound(spark, root + "/inbound", root + "/audit", root + "/_checkpoint",
                       text_audit_rows(TEXT_COLUMNS), processed=root + "/processed",
                       error=root + "/error", pattern="*.txt",
                       max_files_per_trigger=4).awaitTermination()

    fx.write_cycle_files(spark, sf_dir, root + "/inbound")
    intake()
    fx.write_resent_files(spark, sf_dir, root + "/inbound")
    intake()
    intake()
    out = spark.read.parquet(root + "/audit")
    return out.select(*COLS7, "rownumber", "billcycle", "filename")


def _llm():
    """Registry of the training-data operators and the pipeline module; ``None`` where that
    subpackage is not installed. Any other import error is raised."""
    try:
        import corpus_pipeline
        from sluice.llm import registry
    except ModuleNotFoundError as exc:
        if exc.name not in {"corpus_pipeline", "sluice.llm", "sluice.llm.registry"}:
            raise
        return None
    return registry, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = _own_queries()
    if llm := _llm():
        out |= llm[0].queries()
        out["pipeline"] = llm[1].run
    return out


def oracle_sql() -> dict[str, str]:
    out = _own_oracle_sql()
    if llm := _llm():
        out |= llm[0].oracle_sql()
        if llm[1].ORACLE_SQL is not None:
            out["pipeline"] = llm[1].ORACLE_SQL
    return out


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "text_scan": q_text_scan,
        "text_expand": q_text_expand,
        "text_blank_null": q_text_blank_null,
        "record_filter": q_record_filter,
        "text_pipeline": q_text_pipeline,
        "row_stamp": q_row_stamp,
        "norm_text": q_norm_text,
        "bill_cycle": q_bill_cycle,
        "uuid7": q_uuid7,
        "csv_scan": q_csv_scan,
        "header_windows": q_header_windows,
        "header_scores": q_header_scores,
        "header_assign": q_header_assign,
        "header_detect": q_header_detect,
        "preamble_skip": q_preamble_skip,
        "footer_filter": q_footer_filter,
        "blank_row_filter": q_blank_row_filter,
        "headed_project": q_headed_project,
        "flat_rename": q_flat_rename,
        "align_case_insensitive": q_align_case_insensitive,
        "align_exact": q_align_exact,
        "align_skip": q_align_skip,
        "align_typed": q_align_typed,
        "stringify": q_stringify,
        "strip_zero_fraction": q_strip_zero_fraction,
        "max_lengths": q_max_lengths,
        "csv_backup": q_csv_backup,
        "truncate_load": q_truncate_load,
        "append_typed": q_append_typed,
        "load_rejects": q_load_rejects,
        "load_without_schema": q_load_without_schema,
        "main_audit_load": q_main_audit_load,
        "cycle_tables": q_cycle_tables,
        "router": q_router,
        "sheets_flat": q_sheets_flat,
        "workbook_failures": q_workbook_failures,
        "run_failures": q_run_failures,
        "table_copy": q_table_copy,
        "audit_enrich": q_audit_enrich,
        "file_columns": q_file_columns,
        "multi_cycle_load": q_multi_cycle_load,
        "cycle_replace": q_cycle_replace,
        "xlsx_scan": q_xlsx_scan,
        "headed_pipeline": q_headed_pipeline,
        "csv_pipeline": q_csv_pipeline,
        "file_disposition": q_file_disposition,
        "run_report": q_run_report,
        "inbound_stream": q_inbound_stream,
    }


# ---------------------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------------------
_L = """
l AS (
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0
              THEN concat_ws(chr(9), rt, CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))
              ELSE concat_ws(chr(9), rt, CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
                             o_orderstatus, '  ' || o_orderpriority || ' ', '')
         END AS value,
         'orders_' || o_orderstatus || CAST(o_orderkey // 1000000 AS VARCHAR) || '_'
           || lpad(CAST(o_orderkey % 11 + 1 AS VARCHAR), 2, '0') || '.txt' AS fname
  FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 'H' ELSE 'D' END AS rt FROM orders)
),
s AS (SELECT *, string_split_regex(value, '\\t') AS f FROM l)
"""


def _cols(expr: str) -> str:
    return ", ".join(expr.format(i=i) + f" AS column{i}" for i in range(1, TEXT_COLUMNS + 1))


_TRIM = _cols("trim(f[{i}])")
_NULLIF = _cols("nullif(trim(f[{i}]), '')")

# Python-whitespace class, same text as sluice.functions.text.WHITESPACE_CLASS
_WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")


def _arr(vals):
    return "[" + ", ".join(v if v.startswith(("CAST", "'Branch")) else "'" + v.replace("'", "''") + "'" for v in vals) + "]"

HE = ["Account No", "Customer Name", "Account Balance", "Market Segment", "", "Note"]
HT = ["", "Customer", "", "Market", "", ""]
HO = ["Account No", "Name", "Account Balance", "Segment", "", "Note"]
BL = [""] * 6

R_GRID = f"""
rc AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey AS n,
              'report_' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '_'
                || CAST(c_custkey // 1000000 AS VARCHAR) AS sheet FROM customer),
rs AS (SELECT DISTINCT sheet, n FROM rc),
rg0 AS (
  SELECT sheet, 0 AS sec, 0 AS k, sub,
         CASE sub WHEN 0 THEN ['Monthly Statement', '', '', '', '', '']
                  WHEN 1 THEN ['Branch ' || CAST(n AS VARCHAR), '', '', '', '', '']
                  ELSE {_arr(BL)} END AS cells
  FROM rs, range(0, 3) p(sub) WHERE sub < n % 4
  UNION ALL
  SELECT sheet, 1, 0, sub,
         CASE WHEN n % 2 = 0 THEN {_arr(HE)} WHEN sub = 0 THEN {_arr(HT)} ELSE {_arr(HO)} END
  FROM rs, range(0, 2) p(sub) WHERE sub < CASE WHEN n % 2 = 0 THEN 1 ELSE 2 END
  UNION ALL
  SELECT sheet, 2, c_custkey, sub,
         CASE WHEN sub = 0 THEN [CAST(c_custkey AS VARCHAR), c_name,
                                 CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), c_mktsegment, '',
                                 CASE WHEN c_custkey % 13 = 0 THEN 'Page 3' ELSE '' END]
              ELSE {_arr(BL)} END
  FROM rc, range(0, 2) p(sub) WHERE sub = 0 OR c_custkey % 10 = 9
  UNION ALL
  SELECT sheet, 3, 0, sub, CASE sub WHEN 0 THEN ['Page 1 of 1', '', '', '', '', '']
                                   ELSE ['Run time: 3 s', '', '', '', '', ''] END
  FROM rs, range(0, 2) p(sub)),
rg AS (SELECT sheet, row_number() OVER (PARTITION BY sheet ORDER BY sec, k, sub) AS rn,
              list_transform(cells, lambda x: nullif(x, '')) AS cells FROM rg0)
"""

def _nsql(x):
    s = f"trim(regexp_replace(coalesce({x}, ''), '{_WS}', ' ', 'g'))"
    return f"CASE WHEN lower({s}) = 'none' THEN '' ELSE {s} END"

def _canon(x):
    return f"replace(replace(lower({x}), ' ', ''), '-', '')"

R_WIN = f"""
samp AS (SELECT * FROM rg WHERE rn <= 50),
ns AS (SELECT sheet, count(*) AS n FROM samp GROUP BY sheet),
win AS (SELECT ns.sheet, s.start, h.height FROM ns, range(0, 15) s(start), range(1, 10) h(height)
        WHERE s.start < ns.n AND s.start + h.height <= ns.n),
wc AS (SELECT w.sheet, w.start, w.height, c.c,
              string_agg(v, ' ' ORDER BY samp.rn) FILTER (WHERE v <> '') AS s
       FROM win w JOIN samp ON samp.sheet = w.sheet AND samp.rn > w.start AND samp.rn <= w.start + w.height
       CROSS JOIN range(0, 6) c(c)
       CROSS JOIN LATERAL (SELECT {_nsql('samp.cells[c.c + 1]')} AS v) nv
       GROUP BY w.sheet, w.start, w.height, c.c),
tg AS (SELECT t, th, {_canon('th')} AS b FROM (VALUES (0, 'Account No'), (1, 'Customer Name'),
       (2, 'Account Balance'), (3, 'Market Segment')) v(t, th)),
sc AS (SELECT sheet, start, height, c, t, th,
              CASE WHEN a = b THEN 1.0 WHEN contains(a, b) OR contains(b, a) THEN 0.8
                   WHEN len(list_intersect(list_distinct(list_filter(string_split(a, ''), lambda z: z <> '')),
                                           list_distinct(list_filter(string_split(b, ''), lambda z: z <> '')))) >= 3
                   THEN 0.7 ELSE 0.0 END AS score
       FROM (SELECT *, {_canon('s')} AS a FROM wc WHERE s IS NOT NULL AND s <> '') x CROSS JOIN tg),
asg AS (SELECT sheet, start, height,
               list_reduce(cands, lambda acc, y:
                   CASE WHEN list_contains(list_transform(acc, lambda q: q.c), y.c)
                          OR list_contains(list_transform(acc, lambda q: q.t), y.t)
                        THEN acc ELSE list_append(acc, y) END,
                   list_filter([{{'c': 0, 't': 0, 'th': '', 'score': 0.0}}], lambda q: false)) AS m
        FROM (SELECT sheet, start, height,
                     list({{'c': c, 't': t, 'th': th, 'score': score}} ORDER BY score DESC, c, t) AS cands
              FROM sc WHERE score >= 0.7 GROUP BY sheet, start, height)),
det AS (SELECT sheet, start + height - 1 AS header_end, len(m) AS n, m FROM (
          SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY len(m) DESC, start, height) AS r
          FROM asg WHERE len(m) > 0) WHERE r = 1)
"""


_NULLIF_CELLS = "list_transform(cells, lambda x: nullif(x, '')) AS cells"
_RCELLS = ", ".join(f"cells[{i + 1}] AS c{i}" for i in range(6))
_FOOT = ("list_bool_or(list_transform(cells, lambda x: regexp_matches(coalesce(x, ''), "
         "'(?i)(report creator|page |run time|generated by|end of report|confidential|rows selected)')))")
_BLANK = "NOT list_bool_or(list_transform(cells, lambda x: coalesce(x, '') <> ''))"
_AFTER = "SELECT rg.* FROM rg JOIN det USING (sheet) WHERE rg.rn > det.header_end + 1"
_MAPTXT = ("array_to_string(list_sort(list_transform(m, lambda x: lpad(CAST(x.c AS VARCHAR), 3, '0')"
           " || '=' || x.th)), ';')")


def _target_cols(prefix=""):
    out = []
    for i, th in enumerate(["Account No", "Customer Name", "Account Balance", "Market Segment"]):
        out.append(f"trim(cells[list_filter(m, lambda x: x.t = {i})[1].c + 1]) AS \"{th}\"")
    return ", ".join(out)


_P_STR = ("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, trim(p_name) AS p_name, "
          "trim(p_brand) AS p_brand, trim(p_type) AS p_type, CAST(p_size AS VARCHAR) AS p_size, "
          "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS p_retailprice FROM part")
_CYCLE = "'BC' || right(regexp_replace(fname, '^(.*[^.].*)\\.[^.]*$', '\\1'), 2)"


# File outcomes over reports whose sheets with nation % 8 = 3 are blanked, plus one missing
# path: detection runs over every sheet; a sheet without a match is empty_data.
_R_BLANKED = R_GRID.replace(
    "list_transform(cells, lambda x: nullif(x, '')) AS cells FROM rg0)",
    "CASE WHEN rs.n % 8 = 3 THEN list_transform(rg0.cells, lambda x: CAST(NULL AS VARCHAR)) "
    "ELSE list_transform(rg0.cells, lambda x: nullif(x, '')) END AS cells "
    "FROM rg0 JOIN rs USING (sheet))")
_DISP = (f"WITH {_R_BLANKED}, {R_WIN}, "
         "cnt AS (SELECT a.sheet, count(*) AS n_rows FROM (SELECT rg.*, det.m FROM rg JOIN det USING (sheet) "
         f"WHERE rg.rn > det.header_end + 1) a WHERE NOT {_FOOT} AND NOT ({_BLANK}) GROUP BY a.sheet) "
         "SELECT rs.sheet || '.csv' AS filename, CASE WHEN rs.sheet IN (SELECT sheet FROM det) "
         "THEN 'processed' ELSE 'empty_data' END AS status, "
         "CAST(coalesce(cnt.n_rows, 0) AS BIGINT) AS n_rows "
         "FROM rs LEFT JOIN cnt USING (sheet) "
         "UNION ALL SELECT 'report_99_9.csv', 'missing_file', CAST(0 AS BIGINT)")


_REASON = ("CASE WHEN status = 'missing_file' THEN 'input object not found' WHEN status = 'empty_data' "
           "THEN 'Fuzzy matcher failed or sheet is blank' END")


def _sql_str(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    return " || ".join(f"'{ch}'" if 32 <= ord(ch) < 127 and ch != "'" else f"chr({ord(ch)})"
                       for ch in v) or "''"


def _sql_values(rows) -> str:
    return ", ".join(f"({k}, {_sql_str(v)})" for k, v in rows)


def _own_oracle_sql() -> dict[str, str]:
    return {
        "text_expand": f"WITH {_L} SELECT o_orderkey, {_TRIM} FROM s",
        "text_blank_null": f"WITH {_L} SELECT o_orderkey, {_NULLIF} FROM s",
        "record_filter": f"WITH {_L}, e AS (SELECT o_orderkey, {_NULLIF} FROM s) "
                         "SELECT * FROM e WHERE column1 = 'H'",
        "text_pipeline": f"WITH {_L}, e AS (SELECT {_NULLIF}, fname AS filename, "
                         "row_number() OVER (PARTITION BY fname ORDER BY o_orderkey) AS rownumber "
                         "FROM s) SELECT * FROM e WHERE column1 = 'D'",
        "row_stamp": """
            SELECT 'events_' || event_type || '_' || CAST(event_id // 1000000 AS VARCHAR) || '.txt'
                     AS filename,
                   row_number() OVER (PARTITION BY event_type, event_id // 1000000
                                      ORDER BY event_id) AS rownumber,
                   concat_ws(chr(9), CAST(event_id AS VARCHAR), event_type,
                             CAST(user_id AS VARCHAR)) AS value
            FROM events""",
        "text_scan": """
            SELECT lang, CAST(sum(len(parts)) AS BIGINT) AS n_lines,
                   CAST(sum(len(list_filter(parts, lambda x: x = ''))) AS BIGINT) AS n_blank,
                   CAST(sum(list_sum(list_transform(parts, lambda x: length(x)))) AS BIGINT) AS n_chars
            FROM (SELECT lang, string_split(text, chr(10)) AS parts FROM documents)
            GROUP BY lang""",
        "norm_text": f"""
            WITH d AS (
              SELECT doc_id, text FROM documents
              UNION ALL SELECT * FROM (VALUES {_sql_values(NORM_EDGES)}) v(doc_id, text)),
            c AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g')) AS s
                  FROM d)
            SELECT doc_id, CASE WHEN lower(s) = 'none' THEN '' ELSE s END AS norm FROM c""",
        "bill_cycle": """
            SELECT o_orderkey, fname AS filename,
                   'BC' || right(regexp_replace(fname, '^(.*[^.].*)\\.[^.]*$', '\\1'), 2) AS billcycle
            FROM (SELECT o_orderkey, 'orders_' || o_orderstatus || CAST(o_orderkey // 1000000 AS VARCHAR)
                    || '_' || lpad(CAST(o_orderkey % 11 + 1 AS VARCHAR), 2, '0') || '.txt' AS fname
                  FROM orders)""",
        "uuid7": "SELECT count(*) AS n_rows, count(*) AS n_valid, count(*) AS n_distinct FROM events",
        "csv_scan": f"WITH {R_GRID} SELECT sheet, rn AS rownumber, {_RCELLS} FROM rg",
        "header_windows": f"WITH {R_GRID}, {R_WIN} SELECT sheet, start, height, c, s AS text "
                          "FROM wc WHERE s IS NOT NULL AND s <> ''",
        "header_scores": f"WITH {R_GRID}, {R_WIN} SELECT sheet, start, height, c, th AS target, "
                         "CAST(score AS DOUBLE) AS score FROM sc WHERE score >= 0.7",
        "header_assign": f"WITH {R_GRID}, {R_WIN} SELECT sheet, start, height, x.c AS c, "
                         "x.th AS target FROM (SELECT sheet, start, height, unnest(m) AS x FROM asg)",
        "header_detect": f"WITH {R_GRID}, {R_WIN} SELECT sheet, header_end, n, {_MAPTXT} AS mapping "
                         "FROM det",
        "preamble_skip": f"WITH {R_GRID}, {R_WIN}, a AS ({_AFTER}) "
                         f"SELECT sheet, rn AS rownumber, {_RCELLS} FROM a",
        "footer_filter": f"WITH {R_GRID}, {R_WIN}, a AS ({_AFTER}) "
                         f"SELECT sheet, rn AS rownumber, {_RCELLS} FROM a WHERE NOT {_FOOT}",
        "blank_row_filter": f"WITH {R_GRID}, {R_WIN}, a AS ({_AFTER}) "
                            f"SELECT sheet, rn AS rownumber, {_RCELLS} FROM a WHERE NOT ({_BLANK})",
        "headed_project": f"WITH {R_GRID}, {R_WIN}, a AS (SELECT rg.*, det.m FROM rg JOIN det USING (sheet) "
                          "WHERE rg.rn > det.header_end + 1) "
                          f"SELECT sheet, rn AS rownumber, {_target_cols()} FROM a "
                          f"WHERE NOT {_FOOT} AND NOT ({_BLANK})",
        "flat_rename": f"WITH {R_GRID} SELECT sheet, rn AS rownumber, "
                       + ", ".join(f"cells[{i}] AS column{i}" for i in range(1, 7)) + " FROM rg",
        "align_case_insensitive": 'SELECT c_custkey AS "C_CUSTKEY", c_mktsegment AS "C_MKTSEGMENT", '
                                  'c_name AS "C_NAME", CAST(NULL AS VARCHAR) AS "EXTRA_COL", '
                                  'CAST(NULL AS VARCHAR) AS "ROW_ID" FROM customer',
        "align_exact": 'SELECT c_custkey, CAST(NULL AS VARCHAR) AS "C_NAME", c_mktsegment, '
                       'CAST(NULL AS VARCHAR) AS extra FROM customer',
        "align_skip": 'SELECT c_custkey AS "C_CUSTKEY", c_mktsegment AS "C_MKTSEGMENT", '
                      'c_name AS "C_NAME", CAST(NULL AS VARCHAR) AS "EXTRA_COL" FROM customer',
        "align_typed": 'SELECT c_custkey AS "C_CUSTKEY", c_acctbal AS "C_ACCTBAL", '
                       'c_nationkey AS "C_NATIONKEY", c_name AS "C_NAME", '
                       'TRY_CAST(c_mktsegment AS INTEGER) AS "C_MKTSEGMENT" FROM customer',
        "stringify": _P_STR,
        "strip_zero_fraction": _P_STR.replace(
            "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS p_retailprice",
            "regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '\\.0*$', '') "
            "AS p_retailprice"),
        "max_lengths": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(max(length(CAST({e} AS VARCHAR))) AS BIGINT) AS max_len "
            "FROM customer" for c, e in (
                ("c_custkey", "c_custkey"), ("c_name", "c_name"), ("c_nationkey", "c_nationkey"),
                ("c_acctbal", "CAST(c_acctbal AS DECIMAL(18,2))"), ("c_mktsegment", "c_mktsegment"))),
        "append_typed": " UNION ALL ".join(
            f'SELECT c_custkey AS "C_CUSTKEY", {n} AS "C_NAME", c_nationkey AS "C_NATIONKEY" '
            "FROM customer" for n in ("c_name", "lower(c_name)")),
        "load_rejects": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS rejects, count(*) AS nulls_loaded "
            f"FROM orders WHERE o_orderkey % {k} = 0" for c, k in
            (("O_CUSTKEY", 7), ("O_TOTALPRICE", 11))),
        "load_without_schema": f"WITH {_L}, a AS (SELECT {_NULLIF} FROM s) "
                               "SELECT 'main' AS part, * FROM a UNION ALL SELECT 'audit', * FROM a",
        "main_audit_load": f"WITH {_L}, a AS (SELECT {_NULLIF}, fname, row_number() OVER "
                           "(PARTITION BY fname ORDER BY o_orderkey) AS rn FROM s), "
                           "b AS (SELECT fname, coalesce(sum(n) OVER (ORDER BY fname ROWS BETWEEN "
                           "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM "
                           "(SELECT fname, count(*) AS n FROM a GROUP BY fname)) "
                           "SELECT 'main' AS part, CAST(NULL AS VARCHAR) AS filename, "
                           f"CAST(base + rn AS BIGINT) AS number, {', '.join(COLS7)} "
                           "FROM a JOIN b USING (fname) UNION ALL "
                           f"SELECT 'audit', fname, rn, {', '.join(COLS7)} FROM a",
        "cycle_tables": f"WITH {_L} SELECT {_CYCLE} AS cycle_table, {_NULLIF} FROM s",
        "router": f"WITH {_L} SELECT {_NULLIF} FROM s",
        "sheets_flat": f"WITH {R_GRID} SELECT sheet, row_number() OVER (PARTITION BY sheet "
                       "ORDER BY sec, k, sub) AS rownumber, "
                       + ", ".join(f"cells[{i}] AS column{i}" for i in range(1, 7)) + " FROM rg0",
        "workbook_failures": f"WITH {R_GRID.replace(_NULLIF_CELLS, 'cells AS cells')}, {R_WIN}, "
                             "a AS (SELECT rg.*, det.m FROM rg JOIN det USING (sheet) "
                             "WHERE rg.rn > det.header_end + 1) "
                             "SELECT sheet || '.xlsx' AS filename, 'processed' AS status, "
                             f"count(*) AS n_rows FROM a WHERE NOT {_FOOT} AND NOT ({_BLANK}) "
                             "GROUP BY sheet UNION ALL "
                             "SELECT 'broken_99.xlsx', 'pipeline_failure', 0",
        "csv_backup": "SELECT s_suppkey, s_name, s_nationkey, "
                      "CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS s_acctbal FROM supplier",
        "truncate_load": 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "N_NAME", '
                         'n_regionkey AS "N_REGIONKEY" FROM nation',
        "table_copy": 'SELECT CAST(p_partkey AS VARCHAR) AS "P_PARTKEY", p_name AS "P_NAME", '
                      "regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), "
                      "'\\.0*$', '') AS \"P_RETAILPRICE\", CAST(p_size AS VARCHAR) AS \"P_SIZE\", "
                      'CAST(NULL AS VARCHAR) AS "P_CONTAINER", p_brand AS "P_BRAND" FROM part',
        "audit_enrich": f"WITH {_L} SELECT {_NULLIF}, "
                        "row_number() OVER (PARTITION BY fname ORDER BY o_orderkey) AS rownumber, "
                        f"{_CYCLE} AS billcycle, fname AS filename, true AS id_valid, "
                        "true AS has_time FROM s",
        "file_columns": f"WITH {_L} SELECT {_NULLIF}, fname AS filename, true AS has_dateread FROM s",
        "multi_cycle_load": f"WITH {_L}, a AS (SELECT {_NULLIF}, "
                            "row_number() OVER (PARTITION BY fname ORDER BY o_orderkey) AS rownumber, "
                            f"{_CYCLE} AS billcycle, fname AS filename FROM s) "
                            f"SELECT billcycle, filename, rownumber, {', '.join(COLS7)} FROM a",
        "xlsx_scan": f"WITH {R_GRID} SELECT sheet, row_number() OVER (PARTITION BY sheet "
                     f"ORDER BY sec, k, sub) AS rownumber, {_RCELLS} FROM rg0",
        "headed_pipeline": f"WITH {R_GRID.replace(_NULLIF_CELLS, 'cells AS cells')}, {R_WIN}, "
                           "a AS (SELECT rg.*, det.m FROM rg JOIN det USING (sheet) "
                           "WHERE rg.rn > det.header_end + 1) "
                           f"SELECT {_target_cols()}, rn AS rownumber, "
                           "'BC' || right(sheet, 2) AS billcycle, sheet || '.xlsx' AS filename, "
                           f"true AS id_valid FROM a WHERE NOT {_FOOT} AND NOT ({_BLANK})",
        "csv_pipeline": f"WITH {R_GRID}, {R_WIN}, a AS (SELECT rg.*, det.m FROM rg JOIN det USING (sheet) "
                        "WHERE rg.rn > det.header_end + 1), p AS ("
                        f"SELECT {_target_cols()}, sheet || '.csv' AS filename FROM a "
                        f"WHERE NOT {_FOOT} AND NOT ({_BLANK})) "
                        'SELECT "Market Segment" AS "market segment", "Account No" AS "account no", '
                        '"Customer Name" AS "customer name", filename, true AS dateread, '
                        '"Account Balance" AS "account balance" FROM p',
        "file_disposition": f"WITH d AS ({_DISP}), r AS (SELECT *, {_REASON} AS reason FROM d) "
                            "SELECT filename, status, reason, n_rows, "
                            "CASE WHEN reason IS NOT NULL THEN status END AS payload_status, "
                            "reason AS payload_reason, "
                            "CASE WHEN reason IS NOT NULL THEN filename END AS payload_file, "
                            "CASE status WHEN 'processed' THEN 'processed/' || filename "
                            "WHEN 'missing_file' THEN NULL ELSE 'error/' || filename END "
                            "AS moved_to FROM r",
        "run_report": f"WITH d AS ({_DISP}) SELECT count(*) AS n_units, "
                      "count(*) FILTER (WHERE status <> 'processed') AS n_failed FROM d",
        "run_failures": f"WITH d AS ({_DISP}) SELECT filename AS unit, '[' || filename || ']: ' || "
                        f"status || ' - ' || {_REASON} AS line FROM d WHERE status <> 'processed'",
        "inbound_stream": f"WITH {_L}, s2 AS (SELECT * REPLACE (CASE WHEN o_orderkey % 11 < 2 "
                          "THEN string_split_regex(lower(value), '\\t') ELSE f END AS f), "
                          "'orders_inbound' || CAST(o_orderkey // 1000000 AS VARCHAR) || '_' || "
                          "lpad(CAST(o_orderkey % 11 + 1 AS VARCHAR), 2, '0') || '.txt' AS fn "
                          "FROM s JOIN orders USING (o_orderkey) "
                          "WHERE o_orderkey % 11 >= 2 OR o_custkey % 2 = 0) "
                          f"SELECT {_NULLIF}, row_number() OVER (PARTITION BY fn ORDER BY o_orderkey) "
                          f"AS rownumber, 'BC' || lpad(CAST(o_orderkey % 11 + 1 AS VARCHAR), 2, '0') "
                          "AS billcycle, fn AS filename FROM s2",
        "cycle_replace": f"WITH {_L}, a AS (SELECT {_NULLIF}, "
                         "row_number() OVER (PARTITION BY fname ORDER BY o_orderkey) AS rownumber, "
                         f"{_CYCLE} AS billcycle, fname AS filename FROM s) "
                         "SELECT column1, column2, column3, column4, CASE WHEN billcycle IN "
                         "('BC01', 'BC02') THEN lower(column5) ELSE column5 END AS column5, "
                         "column6, column7, rownumber, billcycle, filename FROM a",
    }
