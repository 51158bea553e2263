"""Input files derived by Spark from the given tables, for registered queries and tests.

The reference reads business files (delimited text, CSV reports, workbooks). The benchmark
tables are parquet, so these builders turn whole tables into such files with Spark jobs:
one file per derived name, lines in a stated order, written below the shared scratch folder.
Every file holds one name's rows; names include a key range (``CHUNK``) so no file, and no
writing task, grows with the table.
"""

from __future__ import annotations

import io
import posixpath
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources.files import list_files, rename, delete, _fs_and_path

# --- fixture parameters ------------------------------------------------------------------
CHUNK = 1_000_000          # key range per file: bounds every file and writer task
DOC_CHUNK = 10_000         # the same for documents, whose rows are long
GRID_WIDTH = 6             # cells per report row
TARGET_HEADERS = "Account No, Customer Name, Account Balance, Market Segment"
PREAMBLE = ("Monthly Statement", "Branch {n}", "")      # first n % 4 of these
HEADER_EVEN = ("Account No", "Customer Name", "Account Balance", "Market Segment", "", "Note")
HEADER_ODD_TOP = ("", "Customer", "", "Market", "", "")
HEADER_ODD = ("Account No", "Name", "Account Balance", "Segment", "", "Note")
FOOTERS = ("Page 1 of 1", "Run time: 3 s")
NOTE_TEXT = "Page 3"       # note on every customer with key % 13 = 0 (row is a footer match)
# ----------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_named_files(df: DataFrame, name_col: str, order_cols, folder: str,
                      text_col: str = "value") -> list[str]:
    """One text file per distinct ``name_col`` value (file name = the value), lines sorted.

    Rows are hash-partitioned by name, so each file is written by exactly one task; the
    files are then renamed out of Spark's partition folders (metadata operations only).
    """
    spark = df.sparkSession
    staging = folder.rstrip("/") + "/_staging"
    (df.select(text_col, name_col, *order_cols)
       .repartition(name_col)
       .sortWithinPartitions(name_col, *order_cols)
       .select(text_col, name_col)
       .write.partitionBy(name_col).text(staging))
    from concurrent.futures import ThreadPoolExecutor

    fs, root = _fs_and_path(spark, staging)
    jvm = spark.sparkContext._jvm
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    dirs = [st.getPath().toString() for st in fs.listStatus(root) if st.isDirectory()]

    def publish(d: str) -> str:
        name = unescape(d.rsplit("/", 1)[-1].split("=", 1)[1])
        parts = list_files(spark, d)
        if len(parts) != 1:
            raise RuntimeError(f"expected one file for {name}, found {len(parts)}")
        dst = f"{folder.rstrip('/')}/{name}"
        rename(spark, parts[0], dst)
        return dst

    with ThreadPoolExecutor(max_workers=16) as pool:     # metadata renames only
        out = list(pool.map(publish, dirs))
    delete(spark, staging)
    return sorted(out)


# --- L: delimited lines from orders ------------------------------------------------------
def order_lines(orders: DataFrame) -> DataFrame:
    """``(o_orderkey, o_orderstatus, value)``: tab-separated record lines, some short."""
    k = F.col("o_orderkey")
    rtype = F.when(k % 10 == 0, F.lit("H")).otherwise(F.lit("D"))
    full = F.concat_ws("\t", rtype, k.cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"),
                       F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")), F.lit(""))
    short = F.concat_ws("\t", rtype, k.cast("string"), F.col("o_custkey").cast("string"))
    return orders.select("o_orderkey", "o_orderstatus",
                         F.when(k % 7 == 0, short).otherwise(full).alias("value"))


def cycle_file_name(status: Column, key: Column) -> Column:
    """``orders_{status}{chunk}_{cc}.txt`` with cycle ``cc`` = key % 11 + 1, two digits."""
    return F.concat(F.lit("orders_"), status, (key / CHUNK).cast("long").cast("string"), F.lit("_"),
                    F.lpad((key % 11 + 1).cast("string"), 2, "0"), F.lit(".txt"))


def write_order_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    lines = order_lines(table(spark, sf_dir, "orders"))
    lines = lines.withColumn("fname", cycle_file_name(F.col("o_orderstatus"), F.col("o_orderkey")))
    return write_named_files(lines, "fname", ["o_orderkey"], folder)


def write_cycle_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """L as the inbound folder receives it: ``orders_inbound{chunk}_{cc}.txt`` per cycle and key
    range."""
    return _write_cycles(order_lines(table(spark, sf_dir, "orders")), folder)


def write_resent_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """The files of the first two cycles as they are sent again: the same names, without the
    orders of odd customers and in lower case."""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 11 < 2 AND o_custkey % 2 = 0")
    return _write_cycles(order_lines(orders).withColumn("value", F.lower("value")), folder)


def _write_cycles(lines: DataFrame, folder: str) -> list[str]:
    name = F.concat(F.lit("orders_inbound"),
                    (F.col("o_orderkey") / CHUNK).cast("long").cast("string"), F.lit("_"),
                    F.lpad((F.col("o_orderkey") % 11 + 1).cast("string"), 2, "0"), F.lit(".txt"))
    return write_named_files(lines.withColumn("fname", name), "fname", ["o_orderkey"], folder)


# --- lineitem lines (largest table) -----------------------------------------------------
def write_lineitem_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """Tab-separated lineitem records, one file per (return flag, line status, key range)."""
    li = table(spark, sf_dir, "lineitem")
    value = F.concat_ws("\t", F.lit("D"), *[F.col(c).cast("string") for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")])
    fname = F.concat(F.lit("lineitem_"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("_"),
                     (F.col("l_orderkey") / CHUNK).cast("long").cast("string"), F.lit(".txt"))
    return write_named_files(li.select(value.alias("value"), fname.alias("fname"), "l_orderkey",
                                       "l_linenumber"), "fname", ["l_orderkey", "l_linenumber"],
                             folder)


# --- event lines --------------------------------------------------------------------------
def write_event_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    ev = table(spark, sf_dir, "events")
    value = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("event_type"),
                        F.col("user_id").cast("string"))
    fname = F.concat(F.lit("events_"), F.col("event_type"), F.lit("_"),
                     (F.col("event_id") / CHUNK).cast("long").cast("string"), F.lit(".txt"))
    return write_named_files(ev.select(value.alias("value"), fname.alias("fname"), "event_id"),
                             "fname", ["event_id"], folder)


# --- documents as text files --------------------------------------------------------------
def write_document_files(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    docs = table(spark, sf_dir, "documents")
    fname = F.concat(F.lit("docs_"), F.col("lang"), F.lit("_"),
                     (F.col("doc_id") / DOC_CHUNK).cast("long").cast("string"), F.lit(".txt"))
    return write_named_files(docs.select(F.col("text").alias("value"), fname.alias("fname"),
                                         "doc_id"), "fname", ["doc_id"], folder)


# --- R: report grids from customer --------------------------------------------------------
def _row(values) -> Column:
    return F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])


def report_grid(customer: DataFrame, blank_sheet: Column | None = None) -> DataFrame:
    """``(sheet, sec, k, sub, cells ARRAY<STRING>)``: one report per (nation, key range).

    Order within a sheet is ``(sec, k, sub)``: preamble, header block, data (a blank row after
    every key ending in 9), footers. ``blank_sheet`` (a predicate on ``n``) empties sheets.
    """
    c = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment",
                        F.col("c_nationkey").alias("n"))
    sheet = F.concat(F.lit("report_"), F.lpad(F.col("n").cast("string"), 2, "0"), F.lit("_"),
                     (F.col("c_custkey") / CHUNK).cast("long").cast("string"))
    c = c.withColumn("sheet", sheet)
    sheets = c.select("sheet", "n").distinct()
    blank = [""] * GRID_WIDTH

    def pad(first) -> list:
        return [first] + [""] * (GRID_WIDTH - 1)

    pre = sheets.select("sheet", "n", F.posexplode(F.array(
        _row(pad(PREAMBLE[0])),
        _row(pad(F.concat(F.lit("Branch "), F.col("n").cast("string")))),
        _row(pad(PREAMBLE[2])))).alias("sub", "cells")).filter(F.col("sub") < F.col("n") % 4)
    pre = pre.select("sheet", "n", F.lit(0).alias("sec"), F.lit(0).cast("long").alias("k"),
                     "sub", "cells")
    hdr = sheets.select("sheet", "n", F.posexplode(
        F.when(F.col("n") % 2 == 0, F.array(_row(HEADER_EVEN)))
         .otherwise(F.array(_row(HEADER_ODD_TOP), _row(HEADER_ODD)))).alias("sub", "cells"))
    hdr = hdr.select("sheet", "n", F.lit(1).alias("sec"), F.lit(0).cast("long").alias("k"),
                     "sub", "cells")
    bal = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    note = F.when(F.col("c_custkey") % 13 == 0, F.lit(NOTE_TEXT)).otherwise(F.lit(""))
    data = c.select("sheet", "n", F.lit(2).alias("sec"), F.col("c_custkey").alias("k"),
                    F.explode(F.when(F.col("c_custkey") % 10 == 9,
                                     F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("sub"),
                    F.col("c_custkey").cast("string").alias("c0"), "c_name", bal.alias("bal"),
                    "c_mktsegment", note.alias("note"))
    data = data.select("sheet", "n", "sec", "k", "sub", F.when(
        F.col("sub") == 0,
        F.array(F.col("c0"), F.col("c_name"), F.col("bal"), F.col("c_mktsegment"), F.lit(""),
                F.col("note"))).otherwise(_row(blank)).alias("cells"))
    foot = sheets.select("sheet", "n", F.lit(3).alias("sec"), F.lit(0).cast("long").alias("k"),
                         F.posexplode(F.array(_row(pad(FOOTERS[0])), _row(pad(FOOTERS[1]))))
                         .alias("sub", "cells"))
    grid = pre.unionByName(hdr).unionByName(data).unionByName(foot)
    if blank_sheet is not None:
        grid = grid.withColumn("cells", F.when(blank_sheet, _row(blank)).otherwise(F.col("cells")))
    return grid.drop("n")


def csv_cell(c: Column) -> Column:
    """RFC 4180 quoting when a cell holds a comma, quote or line break."""
    return F.when(c.rlike('[,"\\r\\n]'),
                  F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
                  ).otherwise(c)


def write_report_csv(spark: SparkSession, sf_dir: str, folder: str,
                     blank_sheet: Column | None = None) -> list[str]:
    grid = report_grid(table(spark, sf_dir, "customer"), blank_sheet)
    line = F.array_join(F.transform("cells", csv_cell), ",")
    return write_named_files(
        grid.select(line.alias("value"), F.concat("sheet", F.lit(".csv")).alias("fname"),
                    "sec", "k", "sub"),
        "fname", ["sec", "k", "sub"], folder)


def write_report_xlsx(spark: SparkSession, sf_dir: str, folder: str,
                      blank_sheet: Column | None = None) -> int:
    """One single-sheet workbook per report, built and written by the task owning the group;
    returns how many."""
    import pandas as pd

    grid = report_grid(table(spark, sf_dir, "customer"), blank_sheet)
    root = folder.rstrip("/")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sec", "k", "sub"])
        name = pdf["sheet"].iloc[0]
        path = f"{root}/{name}.xlsx"
        write_bytes(path, build_workbook([list(c) for c in pdf["cells"]], name, dimension=True))
        return pd.DataFrame({"path": [path], "rows": [len(pdf)]})

    out = grid.groupBy("sheet").applyInPandas(build, "path string, rows long")
    return out.count()


# --- minimal workbook writer (fixtures and tests) -----------------------------------------
def _xml_escape(s: str) -> str:
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            .replace('"', "&quot;"))


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, rem = divmod(i - 1, 26)
        s = chr(65 + rem) + s
    return s


def build_workbook(rows, sheet_name: str = "Sheet1", dimension: bool = False) -> bytes:
    """A one-sheet xlsx with inline strings; empty strings are left out as cells. With
    ``dimension`` the used range is declared, as spreadsheet programs write it."""
    rows = [list(r) for r in rows]
    body = []
    for r, cells in enumerate(rows, start=1):
        cs = "".join(
            f'<c r="{_col_letters(i)}{r}" t="inlineStr"><is><t xml:space="preserve">'
            f"{_xml_escape(v)}</t></is></c>"
            for i, v in enumerate(cells) if v not in (None, ""))
        body.append(f'<row r="{r}">{cs}</row>')
    width = max((len(r) for r in rows), default=1) or 1
    dim = f'<dimension ref="A1:{_col_letters(width - 1)}{max(len(rows), 1)}"/>' if dimension else ""
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             f"{dim}<sheetData>{''.join(body)}</sheetData></worksheet>")
    parts = {
        "[Content_Types].xml":
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            "</Types>",
        "_rels/.rels":
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>",
        "xl/workbook.xml":
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            f'<sheets><sheet name="{_xml_escape(sheet_name)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels":
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            "</Relationships>",
        "xl/worksheets/sheet1.xml": sheet,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in parts.items():
            zf.writestr(name, text)
    return buf.getvalue()


def write_bytes(uri: str, data: bytes) -> None:
    """Write one file from an executor through pyarrow's file systems (local, HDFS, S3...)."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") and "://" not in uri:
        uri = uri[len("file:"):]
    filesystem, path = pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)
    filesystem.create_dir(posixpath.dirname(path), recursive=True)
    with filesystem.open_output_stream(path) as out:
        out.write(data)
