"""Benchmark: headline intake jobs at one scale factor; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Input files (text, CSV reports, workbooks) are first written from the tables by Spark
(untimed, reported as ``prepare_sec``); each query is then run once untimed (JVM warm-up:
class loading and JIT dominate first runs at this scale) and once timed, to completion with
a ``noop`` write (full execution, no collect), on the wall clock.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sluice import fixtures as fx  # noqa: E402
from sluice.functions.text import norm_text  # noqa: E402
from sluice.functions.lineage import uuid7  # noqa: E402
from sluice.operators.align import align  # noqa: E402
from sluice.operators.audit import audit_columns, file_columns  # noqa: E402
from sluice.operators.clean import stringify  # noqa: E402
from sluice.operators.stamp import stamp_rows  # noqa: E402
from sluice.plans import headed as HP  # noqa: E402
from sluice.plans.copy import copy_table  # noqa: E402
from sluice.plans.text import parse_text  # noqa: E402
from sluice.session import build_session, scratch_path  # noqa: E402
from sluice.sinks.tables import replace_partitions  # noqa: E402
from sluice.sources.text import read_lines  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", "sluice-bench", cpus)
    sf = sf_dir.rsplit("sf", 1)[-1]

    t0 = time.time()
    root = scratch_path(spark, "bench")
    orders_dir, events_dir, docs_dir = root + "/orders", root + "/events", root + "/docs"
    csv_dir, xlsx_dir = root + "/reports_csv", root + "/reports_xlsx"
    lineitem_dir = root + "/lineitem"
    fx.write_order_files(spark, sf_dir, orders_dir)
    fx.write_lineitem_files(spark, sf_dir, lineitem_dir)
    fx.write_event_files(spark, sf_dir, events_dir)
    fx.write_document_files(spark, sf_dir, docs_dir)
    fx.write_report_csv(spark, sf_dir, csv_dir)
    fx.write_report_xlsx(spark, sf_dir, xlsx_dir)
    prepare = time.time() - t0

    targets = fx.TARGET_HEADERS
    lineitem = fx.table(spark, sf_dir, "lineitem")

    def q_text_pipeline():
        run(parse_text(spark, orders_dir, 7, filter_record_type="D"))

    def q_text_pipeline_lineitem():
        rows = parse_text(spark, lineitem_dir, 11)
        run(audit_columns(rows))

    def q_row_stamp():
        run(stamp_rows(read_lines(spark, events_dir)))

    def q_text_scan():
        lines = read_lines(spark, docs_dir, positioned=False)
        run(lines.groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n")))

    def q_multi_cycle_load():
        audit = audit_columns(parse_text(spark, orders_dir, 7)).drop("sequencialid", "dateprocessed")
        replace_partitions(audit, scratch_path(spark, "bench-audit"))

    def q_header_detect():
        run(HP.detect(HP.csv_grid(spark, csv_dir, width=fx.GRID_WIDTH), fx_targets()))

    def q_csv_pipeline():
        res = HP.ingest_csv(spark, csv_dir, targets, width=fx.GRID_WIDTH)
        run(file_columns(res.data))

    def q_headed_pipeline():
        res = HP.ingest_sheets(spark, xlsx_dir, targets)
        run(audit_columns(res.data))

    def q_norm_text():
        docs = fx.table(spark, sf_dir, "documents")
        run(docs.select("doc_id", norm_text("text").alias("t")))

    def q_table_copy():
        name = f"bench_copy_{uuid.uuid4().hex[:10]}"
        cols = ", ".join(f"{c.upper()} string" for c in lineitem.columns) + ", EXTRA string"
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet "
                  f"LOCATION '{scratch_path(spark, 'bench-copy')}'")
        res = copy_table(lineitem, name, rate_columns=["l_tax"])
        assert res.lengths.count() == len(lineitem.columns) + 1

    def q_align_stringify():
        run(align(stringify(lineitem), lineitem.schema, cast=True))

    def q_uuid7_audit():
        run(lineitem.select("l_orderkey", uuid7().alias("id"), F.current_timestamp().alias("t")))

    def fx_targets():
        from sluice.operators.headers import parse_headers
        return parse_headers(targets)

    queries = {
        "text_pipeline": q_text_pipeline,
        "text_pipeline_lineitem": q_text_pipeline_lineitem,
        "row_stamp": q_row_stamp,
        "text_scan": q_text_scan,
        "multi_cycle_load": q_multi_cycle_load,
        "header_detect": q_header_detect,
        "csv_pipeline": q_csv_pipeline,
        "headed_pipeline": q_headed_pipeline,
        "norm_text": q_norm_text,
        "table_copy": q_table_copy,
        "align_stringify": q_align_stringify,
        "uuid7_audit": q_uuid7_audit,
    }
    times, failed = {}, {}
    for name, fn in queries.items():
        try:
            fn()                       # warm-up run, untimed
            t = time.time()
            fn()
            times[name] = round(time.time() - t, 3)
        except Exception as exc:  # noqa: BLE001 - keep the JSON line; report the failure
            failed[name] = f"{type(exc).__name__}: {exc}"
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(sf), "cpus": cpus,
           "prepare_sec": round(prepare, 3), "timed_run": "second (after one warm-up run)"}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
