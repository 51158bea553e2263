import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from sluice.errors import IntakeError
from sluice.operators.stamp import ROW_COL
from sluice.plans import headed as HP
from sluice.sinks.cycles import read_cycles
from sluice.sinks.tables import (backup_csv, quote_table, replace_keys, replace_partitions,
                                 truncate_load)
from sluice.sources.csv import read_csv_grid
from sluice.fixtures import build_workbook
from sluice.sources.workbook import iter_sheet_rows, read_workbooks
from conftest import local_path, write_text_files


def test_quote_table():
    assert quote_table("sch.tab.x") == '"sch"."tab.x"'
    assert quote_table('we"ird') == '"we""ird"'


def test_truncate_load_replaces_rows_and_checks_names_first(spark, scratch):
    loc = scratch("tbl")
    spark.sql(f"CREATE TABLE t_load (ID int, NAME string, RN bigint) USING parquet LOCATION '{loc}'")
    truncate_load(spark.createDataFrame([(1, "a")], "id int, name string"), "t_load", skip="rn")
    with pytest.raises(IntakeError, match="other"):   # an unknown column stops before the overwrite
        truncate_load(spark.createDataFrame([(1, "a")], "id int, other string"), "t_load")
    with pytest.raises(IntakeError) as e:             # so does a value that does not fit
        truncate_load(spark.createDataFrame([("abc", "b")], "id string, name string"), "t_load")
    assert e.value.status == "database_error" and "ID" in e.value.reason
    assert spark.table("t_load").count() == 1
    truncate_load(spark.createDataFrame([("b", 2), ("c", 3)], "name string, id int"),
                  "t_load", skip="rn")
    assert sorted(tuple(r) for r in spark.table("t_load").collect()) == [(2, "b", None), (3, "c", None)]


def test_replace_partitions_keeps_other_cycles_and_is_idempotent(spark, scratch):
    path = scratch("cycles")
    base = spark.createDataFrame([("BC01", 1), ("BC01", 2), ("BC02", 3)], "billcycle string, v int")
    replace_partitions(base, path)
    new = spark.createDataFrame([("BC01", 9)], "billcycle string, v int")
    replace_partitions(new, path)
    once = sorted(tuple(r) for r in spark.read.parquet(path).select("billcycle", "v").collect())
    replace_partitions(new, path)
    twice = sorted(tuple(r) for r in spark.read.parquet(path).select("billcycle", "v").collect())
    assert once == twice == [("BC01", 9), ("BC02", 3)]


def test_replace_keys_frame(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 5)], "k string, v int")
    assert sorted(tuple(r) for r in replace_keys(old, new, "k").collect()) == [("a", 1), ("b", 5)]


def test_backup_csv_round_trip(spark, scratch):
    path = scratch("bk")
    df = spark.createDataFrame([("1", "x,y")], "a string, b string")
    backup_csv(df, path, files=1)
    assert len([f for f in os.listdir(local_path(path)) if f.endswith(".csv")]) == 1
    assert spark.read.option("header", True).csv(path).first().asDict() == {"a": "1", "b": "x,y"}


def test_csv_title_line_keeps_all_cells(spark, scratch):
    # The first line is a one-cell title; an explicit width keeps the later cells.
    folder = scratch("csv-title")
    write_text_files(folder, {"r.csv": "Title\nAccount No,Customer Name\n\n1,Ann\n"})
    g = HP.csv_grid(spark, folder)
    rows = sorted((r[ROW_COL], list(r.cells)) for r in g.collect())
    assert rows == [(1, ["Title", None]), (2, ["Account No", "Customer Name"]), (3, ["1", "Ann"])]


def test_csv_two_character_separator(spark, scratch):
    folder = scratch("csv-sep")
    write_text_files(folder, {"r.csv": "a||b||c\n"})
    r = read_csv_grid(spark, folder, sep="||", width=3, positioned=False).first()
    assert list(r.cells) == ["a", "b", "c"]


def _sheet_xml_workbook():
    shared = ('<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
              '<si><t>Hello</t></si><si><r><t>Rich </t></r><r><t>text</t></r>'
              '<rPh sb="0" eb="1"><t>PHONETIC</t></rPh></si></sst>')
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
             '<row r="3"><c r="A3"><v>12</v></c><c r="B3"><v>2.5</v></c><c r="D3" t="b"><v>1</v></c></row>'
             '</sheetData></worksheet>')
    src = build_workbook([["x"]])
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(src)) as zin, zipfile.ZipFile(buf, "w") as zout:
        for item in zin.namelist():
            data = zin.read(item)
            if item == "xl/worksheets/sheet1.xml":
                data = sheet.encode()
            zout.writestr(item, data)
        zout.writestr("xl/sharedStrings.xml", shared)
    return buf.getvalue()


def test_workbook_parser_shared_sparse_missing_rows():
    rows = list(iter_sheet_rows(_sheet_xml_workbook()))
    assert rows == [("Sheet1", 1, ["Hello", "", "Rich text", ""]),
                    ("Sheet1", 2, ["", "", "", ""]),
                    ("Sheet1", 3, ["12", "2.5", "", "TRUE"])]


def test_read_workbooks_spark(spark, scratch):
    folder = local_path(scratch("xlsx"))
    os.makedirs(folder)
    for i in range(3):
        with open(os.path.join(folder, f"b{i}.xlsx"), "wb") as f:
            f.write(build_workbook([["h1", "h2"], [str(i), ""]], f"S{i}"))
    g = read_workbooks(spark, folder).collect()
    assert sorted((r.sheet, r[ROW_COL], tuple(r.cells)) for r in g) == sorted(
        [(f"S{i}", 1, ("h1", "h2")) for i in range(3)] + [(f"S{i}", 2, (str(i), "")) for i in range(3)])


def test_missing_workbook_path(spark, scratch):
    with pytest.raises(IntakeError):
        read_workbooks(spark, scratch("none") + "/a.xlsx")


def test_cycle_names_and_inputs():
    from sluice.plans.load import cycle_file_name, cycle_inputs, cycle_table_name
    assert cycle_file_name("invoices_B_01.xlsx", "27") == "invoices_B_27.xlsx"
    assert cycle_table_name("stg.invoices_01", "08") == "stg.invoices_08"
    assert cycle_inputs("s3://b/in/", "f_01.csv", "t_01", ["02", "03"]) == [
        ("s3://b/in/f_02.csv", "t_02"), ("s3://b/in/f_03.csv", "t_03")]


def test_require_rows(spark):
    from sluice.plans.load import require_rows
    with pytest.raises(IntakeError) as e:
        require_rows(spark.range(0), "x")
    assert e.value.status == "empty_data"
    require_rows(spark.range(1))


def test_load_main_and_audit(spark, scratch):
    from sluice.plans.load import load_main_and_audit
    loc, audit_path = scratch("main"), scratch("audit")
    spark.sql(f"CREATE TABLE t_main (A string, RN bigint, B string) USING parquet LOCATION '{loc}'")
    rows = spark.createDataFrame([("x", "y", "f_01.txt", 1), ("z", "w", "f_01.txt", 2)],
                                 "a string, b string, filename string, _temp_row_num long")
    rows = rows.union(spark.createDataFrame([("p", "q", "a_02.txt", 7)], rows.schema))
    load_main_and_audit(rows, "t_main", audit_path, row_label="rn")
    assert sorted(tuple(r) for r in spark.table("t_main").collect()) == [
        ("p", 7, "q"), ("x", 8, "y"), ("z", 9, "w")]
    audit = read_cycles(spark, audit_path)
    assert sorted((r.rownumber, r.billcycle) for r in audit.collect()) == [
        (1, "BC01"), (2, "BC01"), (7, "BC02")]


def test_truncate_load_replaces_all_partitions(spark, scratch):
    loc = scratch("tbl-part")
    spark.sql(f"CREATE TABLE t_part (V int, P string) USING parquet PARTITIONED BY (P) LOCATION '{loc}'")
    truncate_load(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), "t_part")
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        truncate_load(spark.createDataFrame([(3, "a")], "v int, p string"), "t_part")
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.set(key, old)
    assert [tuple(r) for r in spark.table("t_part").collect()] == [(3, "a")]


def test_one_corrupt_workbook_fails_alone(spark, scratch):
    from sluice.plans.jobs import run_report_job
    root = scratch("xlsx-bad")
    folder = local_path(root)
    os.makedirs(folder)
    with open(os.path.join(folder, "good_01.xlsx"), "wb") as f:
        f.write(build_workbook([["Account No", "Name"], ["1", "a"]]))
    with open(os.path.join(folder, "bad_02.xlsx"), "wb") as f:
        f.write(b"no zip")
    spark.sql(f"CREATE TABLE t_xbad (`Account No` string, Name string) USING parquet "
              f"LOCATION '{scratch('xbad')}'")
    res = run_report_job(spark, [root], "Account No, Name", "t_xbad", kind="xlsx")
    got = {r.filename: (r.status, r.n_rows) for r in res.outcomes.collect()}
    assert got == {"good_01.xlsx": ("processed", 1), "bad_02.xlsx": ("pipeline_failure", 0)}
    assert [tuple(r) for r in spark.table("t_xbad").collect()] == [("1", "a")]


def test_append_coerces_to_table_types(spark, scratch):
    from sluice.sinks.tables import append
    loc = scratch("tbl-app")
    spark.sql(f"CREATE TABLE t_app (ID int, AMT double) USING parquet LOCATION '{loc}'")
    append(spark.createDataFrame([("1", "2.5")], "id string, amt string"), "t_app")
    bad = spark.createDataFrame([("x", "3")], "amt string, id string").select("id", "amt")
    with pytest.raises(IntakeError):
        append(bad, "t_app")
    assert append(bad, "t_app", on_cast="null") == {"AMT": 1}
    got = sorted((tuple(r) for r in spark.table("t_app").collect()), key=repr)
    assert got == sorted([(1, 2.5), (3, None)], key=repr)


def test_in_file_order(spark):
    from sluice.operators.stamp import in_file_order
    df = spark.createDataFrame([("b", 2), ("a", 2), ("b", 1), ("a", 1)], "_file string, _temp_row_num long")
    assert [tuple(r) for r in in_file_order(df).collect()] == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_flat_mode_over_ragged_workbooks(spark, scratch):
    folder = local_path(scratch("xlsx-flat"))
    os.makedirs(folder)
    with open(os.path.join(folder, "a.xlsx"), "wb") as f:
        f.write(build_workbook([["x", " y "], ["1"]]))
    with open(os.path.join(folder, "b.xlsx"), "wb") as f:
        f.write(build_workbook([["p", "q", "r"]]))
    flat = HP.ingest_sheets(spark, folder)
    rows = sorted((r.filename, r[ROW_COL], r.column1, r.column2, r.column3) for r in flat.collect())
    assert rows == [("a.xlsx", 1, "x", " y ", None), ("a.xlsx", 2, "1", "", None),
                    ("b.xlsx", 1, "p", "q", "r")]


def test_csv_whitespace_lines_not_numbered(spark, scratch):
    folder = scratch("csv-ws")
    write_text_files(folder, {"a.csv": "a,b\n   \n\t\n\nc,d\n ,\n"})
    g = HP.csv_grid(spark, folder, width=2)
    assert sorted((r[ROW_COL], tuple(r.cells)) for r in g.collect()) == [
        (1, ("a", "b")), (2, ("c", "d")), (3, (" ", None))]


def test_csv_numbering_exact_across_splits_with_skipped_lines(spark, scratch):
    folder = scratch("csv-splits")
    lines, want, n = [], [], 0
    for i in range(3000):
        if i % 7 == 3:
            lines.append("   " if i % 2 else "")
        else:
            lines.append(f"{i},v{i}")
            n += 1
            want.append((n, (str(i), f"v{i}")))
    write_text_files(folder, {"big.csv": "\n".join(lines) + "\n"})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        g = HP.csv_grid(spark, folder, width=2)
        got = sorted((r[ROW_COL], tuple(r.cells)) for r in g.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_workbook_streaming_with_dimension_equals_buffered():
    rows = [["a", "", "c"], [], ["", "x"], ["1", "2", "3"]]
    streamed = list(iter_sheet_rows(build_workbook(rows, dimension=True)))
    held = list(iter_sheet_rows(build_workbook(rows)))
    assert streamed == held == [("Sheet1", 1, ["a", "", "c"]), ("Sheet1", 2, ["", "", ""]),
                                ("Sheet1", 3, ["", "x", ""]), ("Sheet1", 4, ["1", "2", "3"])]


@pytest.mark.parametrize("mode", ["preflight", "observe"])
def test_copy_table_length_audit_modes(spark, scratch, mode):
    from sluice.plans.copy import copy_table
    loc = scratch("copy-" + mode)
    tname = f"t_copy_{mode}"
    spark.sql(f"CREATE TABLE {tname} (ID string, VATRATE string, MISSING string) "
              f"USING parquet LOCATION '{loc}'")
    src = spark.createDataFrame([(1, "12.00"), (22, "7.50")], "id int, VatRate string")
    res = copy_table(src, tname, rate_columns=["vatrate"], lengths=mode)
    assert sorted(tuple(r) for r in spark.table(tname).collect()) == [("1", "12", None),
                                                                      ("22", "7.50", None)]
    assert {r["column"]: r["max_len"] for r in res.lengths.collect()} == {
        "ID": 2, "VATRATE": 4, "MISSING": None}
    assert res.missing == ["MISSING"]


def test_workbook_missing_sheet_name_is_a_clear_error():
    with pytest.raises(ValueError, match="not found"):
        list(iter_sheet_rows(build_workbook([["a"]]), sheet="Nope"))


def _traced(spark, df, folder):
    """``df``, leaving a file in ``folder`` for every partition that is computed."""
    os.makedirs(folder)

    def run(batches):
        import uuid
        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        yield from batches

    return df.mapInArrow(run, df.schema)


def test_a_load_computes_its_input_once(spark, scratch):
    from sluice.sinks.tables import append
    loc = scratch("tbl-once")
    spark.sql(f"CREATE TABLE t_once (ID int, AMT double) USING parquet LOCATION '{loc}'")
    df = spark.range(100).repartition(3).selectExpr("CAST(id AS string) AS id", "'1.5' AS amt")
    for i, load in enumerate((truncate_load, append)):
        folder = local_path(scratch(f"traces{i}"))
        assert load(_traced(spark, df, folder), "t_once") == {}
        assert len(os.listdir(folder)) == 3
    assert spark.table("t_once").count() == 200


@pytest.mark.parametrize("kind", ["external", "partitioned", "managed"])
def test_a_reject_leaves_the_old_table_whole(spark, scratch, kind):
    loc, name = scratch("tbl-whole"), f"t_whole_{kind}"
    where = {"external": f"LOCATION '{loc}'", "managed": "",
             "partitioned": f"PARTITIONED BY (P) LOCATION '{loc}'"}[kind]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (V int, P string) USING parquet {where}")
    good = spark.createDataFrame([("1", "a"), ("2", "b")], "v string, p string")
    truncate_load(good, name)
    truncate_load(good.limit(1), name)
    with pytest.raises(IntakeError) as e:
        truncate_load(spark.createDataFrame([("7", "a"), ("x", "b")], "v string, p string"), name)
    assert e.value.status == "database_error" and "'V': 1" in e.value.reason
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    bad = spark.range(9).selectExpr("raise_error('lost') AS v", "'a' AS p")
    with pytest.raises(Exception, match="lost"):
        truncate_load(bad, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    if kind == "external":     # the shown load and the one before it
        assert len(os.listdir(os.path.join(local_path(loc), "_loads"))) == 2
        for v in "3456":
            truncate_load(spark.createDataFrame([(v, "a")], "v string, p string"), name)
        assert len(os.listdir(os.path.join(local_path(loc), "_loads"))) == 2
    truncate_load(good.limit(0), name, if_empty="keep")
    assert spark.table(name).count() == 1
    truncate_load(good.limit(0), name)
    truncate_load(spark.createDataFrame([], "v string, p string"), name)
    assert spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_a_rejected_main_load_leaves_the_audit_too(spark, scratch):
    from sluice.plans.load import load_main_and_audit
    spark.sql(f"CREATE TABLE t_both (A int) USING parquet LOCATION '{scratch('both')}'")
    path, schema = scratch("both-audit"), "a string, filename string, _temp_row_num long"
    load_main_and_audit(spark.createDataFrame([("1", "f_01.txt", 1)], schema), "t_both", path)
    with pytest.raises(IntakeError) as e:
        load_main_and_audit(spark.createDataFrame([("x", "f_01.txt", 1)], schema), "t_both", path)
    assert e.value.status == "database_error"
    assert [r.a for r in read_cycles(spark, path).collect()] == ["1"]
    assert [r.A for r in spark.table("t_both").collect()] == [1]


def test_an_empty_copy_leaves_the_table(spark, scratch):
    from sluice.plans.copy import copy_table
    spark.sql(f"CREATE TABLE t_cempty (ID int, NAME string) USING parquet "
              f"LOCATION '{scratch('cempty')}'")
    copy_table(spark.createDataFrame([(1, "abc")], "id int, name string"), "t_cempty")
    copy_table(spark.createDataFrame([], "id int, name string"), "t_cempty")
    assert [tuple(r) for r in spark.table("t_cempty").collect()] == [(1, "abc")]


def _numbers(rows, within=None):
    """Plain statement of the row label: files in name order, rows by number."""
    out, base = {}, {}
    last = {}
    for file, n, cycle in rows:
        key = (cycle if within else None, file)
        last[key] = max(last.get(key, 0), n)
    for key in sorted(last):
        total = base.get(key[0], 0)
        for file, n, cycle in rows:
            if (cycle if within else None, file) == key:
                out[file, n, cycle] = total + n
        base[key[0]] = total + last[key]
    return out


@pytest.mark.parametrize("within", [None, "c"])
def test_row_label_is_a_two_level_prefix_sum(spark, scratch, within):
    from sluice.operators.audit import main_columns
    import random
    rng = random.Random(4)
    rows = [(f"file:/in/f{f:03d}.txt", n, f"BC{f % 3}") for f in rng.sample(range(400), 90)
            for n in rng.sample(range(1, 40), rng.randrange(1, 9))]
    df = spark.createDataFrame([(*r, str(r)) for r in rows],
                               "_file string, _temp_row_num long, c string, v string")
    out = main_columns(df, "label", within)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    want = {str(k): v for k, v in _numbers(rows, within).items()}
    assert {r.v: r.label for r in out.collect()} == want


def test_cycle_tables_come_from_one_write(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from sluice.plans.load import load_cycle_tables
    base = scratch("cycle-tables")
    codes = ["01", "02", "03"]
    for c in codes:
        spark.sql(f"CREATE TABLE ct_{c} (A int, RN bigint) USING parquet LOCATION '{base}/t{c}'")
    schema = "a string, filename string, _file string, _temp_row_num long"

    def load(*rows, **options):
        frame = spark.createDataFrame([(a, f, "file:/in/" + f, n) for a, f, n in rows], schema)
        return load_cycle_tables(frame, "ct_00", codes, **options)

    def tables():
        return [sorted(map(tuple, spark.table(f"ct_{c}").collect())) for c in codes]

    writes, real = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (
        writes.append(a), real(self, *a, **k))[1])
    assert load(("1", "x_01.txt", 1), ("2", "x_02.txt", 1), ("3", "y_01.txt", 4),
                ("9", "x_11.txt", 1)) == ["ct_01", "ct_02", "ct_03"]
    assert len(writes) == 1
    assert tables() == [[(1, None), (3, None)], [(2, None)], []]
    load(("5", "x_01.txt", 2), ("6", "y_01.txt", 3), ("7", "z_03.txt", 1), row_label="rn")
    assert tables() == [[(5, 2), (6, 5)], [], [(7, 1)]]
    with pytest.raises(IntakeError) as e:
        load(("x", "x_01.txt", 1), ("8", "x_02.txt", 1))
    assert e.value.status == "database_error"
    assert tables() == [[(5, 2), (6, 5)], [], [(7, 1)]]
    for n in range(3):
        load((str(n), "x_02.txt", 1))
    assert tables() == [[], [(2, None)], []]
    assert len(os.listdir(local_path(base) + "/_shared_loads/ct_01")) == 2
    truncate_load(spark.createDataFrame([(4,)], "a int"), "ct_02")
    load(("1", "x_01.txt", 1))
    assert tables() == [[(1, None)], [], []]


def test_a_schema_that_cannot_be_read_is_a_warning_if_asked(spark, scratch, caplog):
    from sluice.plans.load import load_main_and_audit
    db = "db_" + scratch("x").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch('db')}'")
    rows = spark.createDataFrame([("1", "f_01.txt", 1)], "a string, filename string, _temp_row_num long")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        load_main_and_audit(rows, f"{db}.main")
    with caplog.at_level("WARNING"):
        assert load_main_and_audit(rows, f"{db}.main", on_schema="warn") == {}
    assert "alignment skipped" in caplog.text
    assert [tuple(r) for r in spark.table(f"{db}.main").collect()] == [("1",)]
    with pytest.raises(IntakeError) as e:     # nor can it be created
        truncate_load(rows, "no_such_db.main", on_schema="warn")
    assert e.value.status == "database_error"


def test_cycle_tables_of_several_kinds_are_loaded_from_one_write(spark, scratch):
    from sluice.plans.load import load_cycle_tables
    spark.sql(f"CREATE TABLE ck_01 (A int) USING parquet LOCATION '{scratch('ck1')}'")
    spark.sql(f"CREATE TABLE ck_02 (A string) USING orc LOCATION '{scratch('ck2')}'")
    schema = "a string, filename string, _file string, _temp_row_num long"
    for value in "57":
        rows = [(value, "x_01.txt", "file:/in/x_01.txt", 1), ("b", "y_02.txt", "file:/in/y_02.txt", 1)]
        load_cycle_tables(spark.createDataFrame(rows, schema), "ck_00", ["01", "02"])
        assert [r.A for r in spark.table("ck_01").collect()] == [int(value)]
        assert [r.A for r in spark.table("ck_02").collect()] == ["b"]
