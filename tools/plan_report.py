"""Print the formatted physical plans of the main pipelines (markdown).

    python tools/plan_report.py [sf_dir] > docs/plans.md
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")
from sluice import fixtures as fx  # noqa: E402
from sluice.operators import headers as H  # noqa: E402
from sluice.operators.align import align  # noqa: E402
from sluice.operators.audit import audit_columns, file_columns  # noqa: E402
from sluice.operators.clean import stringify  # noqa: E402
from sluice.plans import headed as HP  # noqa: E402
from sluice.plans.text import parse_text  # noqa: E402
from sluice.session import build_session, scratch_path  # noqa: E402


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session()
    root = scratch_path(spark, "plans")
    fx.write_order_files(spark, sf, root + "/orders")
    fx.write_report_csv(spark, sf, root + "/csv")
    fx.write_report_xlsx(spark, sf, root + "/xlsx")
    rows = parse_text(spark, root + "/orders", 7, filter_record_type="D")
    grid = HP.csv_grid(spark, root + "/csv", width=fx.GRID_WIDTH)
    targets = H.parse_headers(fx.TARGET_HEADERS)
    csv = HP.ingest_csv(spark, root + "/csv", fx.TARGET_HEADERS)
    sheets = HP.ingest_sheets(spark, root + "/xlsx", fx.TARGET_HEADERS)
    li = fx.table(spark, sf, "lineitem")
    cases = {
        "Text intake with audit columns (C1)": audit_columns(rows),
        "Header sample of every report (O2)": H.sample_reports(grid),
        "Header detection per report (H1-H4)": H.detect_headers(H.sample_reports(grid), targets),
        "CSV report intake with file columns (C5)": file_columns(csv.data),
        "Workbook intake with audit columns (C3)": audit_columns(sheets.data),
        "Table copy projection (C6)": stringify(align(li, ["L_ORDERKEY", "L_TAX", "EXTRA"])),
    }
    print("# Physical plans of the main pipelines\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}` (local mode, AQE on; the final")
    print("adaptive plan may differ in partition counts, not in operators).\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```\n{plan(df).strip()}\n```\n")


if __name__ == "__main__":
    main()
