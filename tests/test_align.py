import pytest
from pyspark.sql import functions as F

from sluice.operators.align import align, cast_failures, missing_columns, unknown_columns


@pytest.fixture
def src(spark):
    return spark.createDataFrame([(1, "a", "2.5", "x")], "id long, Name string, amt string, junk string")


def test_case_insensitive_order_missing_extra(src):
    out = align(src, ["NAME", "ID", "extra"])
    assert out.columns == ["NAME", "ID", "extra"]
    assert tuple(out.first()) == ("a", 1, None)


def test_exact_mode_reproduces_case_trap(src):
    out = align(src, ["id", "name", "Name"], match="exact")
    assert tuple(out.first()) == (1, None, "a")


def test_skip_generated_column(src):
    assert align(src, ["ROWNUM", "id"], skip="rownum").columns == ["id"]


def test_typed_alignment_and_failure_count(spark):
    from pyspark.sql.types import _parse_datatype_string as p
    df = spark.createDataFrame([("1", "2.5"), ("x", "3")], "a string, b string")
    schema = p("A int, B double")
    out = align(df, schema, cast=True).collect()
    assert [tuple(r) for r in out] == [(1, 2.5), (None, 3.0)]
    fails = cast_failures(df, schema).first().asDict()
    assert fails == {"A": 1, "B": 0}


def test_missing_and_unknown_lists(src):
    assert missing_columns(src, ["id", "other", "RN"], skip="rn") == ["other"]
    assert unknown_columns(src, ["ID", "name"]) == ["amt", "junk"]


def test_warn_policy_returns_input(src):
    out = align(src, None, on_error="warn")
    assert out is src
    with pytest.raises(Exception):
        align(src, None)


def test_align_is_idempotent(src):
    once = align(src, ["name", "id", "z"])
    assert align(once, ["name", "id", "z"]).collect() == once.collect()
