"""Plan-shape checks: no single-partition exchange over data rows, Python only in the
workbook parser and the position counter, pruned scans, broadcast side tables."""

import pytest

from sluice import fixtures as fx
from sluice.operators.audit import audit_columns, file_columns
from sluice.plans import headed as HP
from sluice.plans.text import parse_text
from conftest import SF_SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark):
    from sluice.session import scratch_path
    root = scratch_path(spark, "plans")
    fx.write_order_files(spark, SF_SMOKE, root + "/orders")
    fx.write_report_csv(spark, SF_SMOKE, root + "/csv")
    fx.write_report_xlsx(spark, SF_SMOKE, root + "/xlsx")
    return root


def test_text_pipeline_plan(spark, files):
    plan = _plan(audit_columns(parse_text(spark, files + "/orders", 7, filter_record_type="D")))
    assert "SinglePartition" not in plan
    # Python counts positions, and gets one long per row; small files need no offsets
    assert "BatchEvalPython" not in plan and plan.count("ArrowEvalPython") == 1
    assert "positions(xxhash64(" in plan and "Join" not in plan
    assert "ReadSchema: struct<value:string>" in plan or "struct<value:string>" in plan


def test_csv_pipeline_plan(spark, files):
    res = HP.ingest_csv(spark, files + "/csv", fx.TARGET_HEADERS, width=fx.GRID_WIDTH)
    plan = _plan(file_columns(res.data))
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and plan.count("ArrowEvalPython") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("FileScan csv") == 1


def test_workbook_pipeline_uses_python_only_to_parse(spark, files):
    res = HP.ingest_sheets(spark, files + "/xlsx", fx.TARGET_HEADERS)
    plan = _plan(res.data)
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan
    # the parsed grid is read from its checkpoint: parsing is not repeated in this plan
    assert "MapInPandas" not in plan


def test_detection_sample_is_partitioned_by_report(spark, files):
    from sluice.operators import headers as H
    g = HP.csv_grid(spark, files + "/csv", width=fx.GRID_WIDTH)
    plan = _plan(H.sample_reports(g))
    assert "hashpartitioning(_file" in plan
    assert plan.count("Exchange hashpartitioning") == 1    # one shuffle of ≤50 rows per report


def test_alignment_prunes_parquet_columns(spark):
    from sluice.operators.align import align
    from sluice.operators.clean import stringify
    li = fx.table(spark, SF_SMOKE, "lineitem")
    out = stringify(align(li, ["L_ORDERKEY", "L_TAX", "MISSING"]))
    plan = _plan(out)
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan


def test_filter_after_alignment_is_pushed_to_parquet(spark):
    from pyspark.sql import functions as F
    from sluice.operators.align import align
    li = fx.table(spark, SF_SMOKE, "lineitem")
    out = align(li, ["L_ORDERKEY", "L_RETURNFLAG"]).filter(F.col("L_RETURNFLAG") == "R")
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
