from sluice.operators.delimited import expand_fields, record_type
from sluice.plans.text import ingest_text, parse_text
from conftest import write_text_files


def test_expand_short_long_and_trailing(spark):
    df = spark.createDataFrame([("A\t b \t",), ("A",), ("A\tb\tc\td",)], "value string")
    rows = expand_fields(df, 3).collect()
    assert [tuple(r) for r in rows] == [("A", "b", None), ("A", None, None), ("A", "b", "c")]


def test_regex_delimiter_and_labels(spark):
    df = spark.createDataFrame([("a|b;;c",)], "value string")
    r = expand_fields(df, 4, regex=r"[|;]", label="f", null_blank=False).first()
    assert r.asDict() == {"f1": "a", "f2": "b", "f3": "", "f4": "c"}


def test_record_type_filter(spark):
    df = spark.createDataFrame([("H",), ("h",), ("D",), (None,)], "column1 string")
    assert record_type(df, "ALL").count() == 4
    assert record_type(df, "all").count() == 4
    assert [r[0] for r in record_type(df, "H").collect()] == ["H"]


def test_numbers_keep_gaps_after_filter(spark, scratch):
    folder = scratch("text-gaps")
    write_text_files(folder, {"inv_x_03.txt": "H\t1\nD\t2\n\nD\t3\n"})
    rows = parse_text(spark, folder, 2, filter_record_type="D").orderBy("_temp_row_num").collect()
    assert [(r.column2, r._temp_row_num) for r in rows] == [("2", 2), ("3", 4)]


def test_ingest_text_exact_alignment_and_audit(spark, scratch):
    folder = scratch("text-ingest")
    write_text_files(folder, {"inv_x_07.txt": "D\t1\t a \nD\t2\t\n"})
    main, audit = ingest_text(spark, folder, 3, target=["column1", "COLUMN2", "column3", "rid"],
                              row_number_label="RID",
                              audit_target=["rownumber", "billcycle", "column2", "extra"])
    assert main.columns == ["column1", "COLUMN2", "column3"]
    assert {tuple(r) for r in main.collect()} == {("D", None, "a"), ("D", None, None)}
    a = audit.orderBy("rownumber").collect()
    assert [tuple(r) for r in a] == [(1, "BC07", "1", None), (2, "BC07", "2", None)]
