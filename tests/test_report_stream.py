import json

from pyspark.sql import functions as F

import pytest
from sluice.errors import IntakeError
from sluice.operators.report import file_disposition, run_failures, run_gate, run_report
from sluice.plans import headed as HP
from sluice.plans.headed import ingest
from sluice.sinks.cycles import read_cycles
from sluice.sources.files import split_existing
from sluice.streaming.inbound import stream_inbound, text_audit_rows
from conftest import local_path, write_text_files


def test_disposition_and_report(spark, scratch):
    folder = scratch("disp")
    write_text_files(folder, {
        "good.csv": "Account No,Name\n1,a\n",
        "nohdr.csv": "zz,qq\n1,2\n",
        "onlyhdr.csv": "Account No,Name\nPage 2,\n",
    })
    found, missing = split_existing(spark, [folder + "/*.csv", folder + "/gone.csv"])
    res = HP.ingest_csv(spark, found, "Account No, Name", width=2)
    files = spark.read.text(found).inputFiles()
    d = file_disposition(spark, files, res.data, res.detected, missing, fail_on_no_rows=True)
    got = {r.filename: (r.status, r.n_rows) for r in d.collect()}
    assert got == {"good.csv": ("processed", 1), "nohdr.csv": ("empty_data", 0),
                   "onlyhdr.csv": ("empty_data", 0), "gone.csv": ("missing_file", 0)}
    payload = d.filter("filename = 'gone.csv'").first().payload
    assert json.loads(payload)["status"] == "missing_file"
    rep = run_report(d).first()
    assert (rep.n_units, rep.n_failed) == (4, 3)
    lines = {r.unit: r.line for r in run_failures(d).collect()}
    assert len(lines) == 3 and lines["gone.csv"].startswith("[gone.csv]: missing_file")
    with pytest.raises(IntakeError, match="3 of 4 units failed") as e:
        run_gate(d)
    assert e.value.status == "orchestration_child_failure"
    run_gate(d.filter("status = 'processed'"))


def test_router(spark, scratch):
    folder = scratch("route")
    write_text_files(folder, {"a_01.txt": "x\ty\n"})
    main, audit = ingest(spark, folder, kind="txt_numbered", expected_columns=2)
    assert tuple(main.first()) == ("x", "y") and audit is None


def test_stream_equals_batch_and_moves_files(spark, scratch):
    root = scratch("stream")
    write_text_files(root + "/inbound", {f"f_{c:02d}.txt": f"D\t{c}\nD\t{c + 100}\n" for c in range(1, 6)})
    q = stream_inbound(spark, root + "/inbound", root + "/sink", root + "/_ck",
                       text_audit_rows(2), processed=root + "/done", error=root + "/err",
                       pattern="*.txt", max_files_per_trigger=2)
    q.awaitTermination()
    out = spark.read.parquet(root + "/sink")
    got = sorted((r.billcycle, r.rownumber, r.column2) for r in out.collect())
    assert got == sorted((f"BC{c:02d}", i + 1, str(v)) for c in range(1, 6)
                         for i, v in enumerate([c, c + 100]))
    import os
    assert sorted(os.listdir(local_path(root + "/done"))) == [f"f_{c:02d}.txt" for c in range(1, 6)]


def test_stream_replay_after_moves_is_harmless(spark, scratch):
    root = scratch("stream-replay")
    write_text_files(root + "/inbound", {"g_01.txt": "D\t1\n", "g_02.txt": "D\t2\n"})
    q = stream_inbound(spark, root + "/inbound", root + "/sink", root + "/_ck", text_audit_rows(2),
                       processed=root + "/done", pattern="*.txt")
    q.awaitTermination()
    # Simulate a lost commit: drop the last commit marker, restart; files are already moved.
    import os
    commits = os.path.join(local_path(root + "/_ck"), "commits")
    last = sorted(f for f in os.listdir(commits) if not f.startswith("."))[-1]
    os.remove(os.path.join(commits, last))
    crc = os.path.join(commits, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    q2 = stream_inbound(spark, root + "/inbound", root + "/sink", root + "/_ck", text_audit_rows(2),
                        processed=root + "/done", pattern="*.txt")
    q2.awaitTermination()
    got = sorted((r.billcycle, r.column2) for r in spark.read.parquet(root + "/sink").collect())
    assert got == [("BC01", "1"), ("BC02", "2")]


def test_move_by_outcome(spark, scratch):
    import os
    from sluice.operators.report import move_by_outcome
    folder = scratch("moves")
    write_text_files(folder + "/in", {"ok.csv": "Account No\n1\n", "bad.csv": "zz\n1\n"})
    res = HP.ingest_csv(spark, folder + "/in/*.csv", "Account No", width=1)
    files = spark.read.text(folder + "/in/*.csv").inputFiles()
    d = file_disposition(spark, files, res.data, res.detected, fail_on_no_rows=False)
    moved = {os.path.basename(r.path): r.moved_to for r in
             move_by_outcome(spark, d, folder + "/processed", folder + "/error").collect()}
    assert moved["ok.csv"].endswith("/processed/ok.csv") and moved["bad.csv"].endswith("/error/bad.csv")
    assert os.listdir(local_path(folder + "/in")) == []


def test_stream_of_csv_reports(spark, scratch):
    from sluice.streaming.inbound import report_audit_rows
    root = scratch("stream-csv")
    write_text_files(root + "/inbound", {
        "rep_01.csv": "Title,\nAccount No,Name\n1,a\nPage 1 of 1,\n",
        "rep_02.csv": "Account No,Name\n2,b\n3,c\n"})
    q = stream_inbound(spark, root + "/inbound", root + "/sink", root + "/_ck",
                       report_audit_rows("Account No, Name", width=2), pattern="*.csv")
    q.awaitTermination()
    got = sorted((r.billcycle, r.rownumber, r["Account No"], r.Name)
                 for r in spark.read.parquet(root + "/sink").collect())
    assert got == [("BC01", 3, "1", "a"), ("BC02", 2, "2", "b"), ("BC02", 3, "3", "c")]


def test_run_report_job_end_to_end(spark, scratch):
    import os
    from sluice.plans.jobs import run_report_job
    root = scratch("job")
    write_text_files(root + "/in", {
        "r_01.csv": "Statement,\nAccount No,Name\n1,a\n2,b\nPage 1 of 1,\n",
        "r_02.csv": "zz,qq\n1,2\n"})
    loc = scratch("job-tbl")
    spark.sql(f"CREATE TABLE t_job (`Account No` string, NAME string, ROW_ID bigint) "
              f"USING parquet LOCATION '{loc}'")
    res = run_report_job(spark, [root + "/in/*.csv", root + "/in/gone.csv"], "Account No, Name",
                         "t_job", audit_path=root + "/audit", processed=root + "/ok",
                         error=root + "/err", row_number_label="row_id", width=2)
    assert sorted(tuple(r) for r in spark.table("t_job").collect()) == [("1", "a", 3),
                                                                       ("2", "b", 4)]
    rep = res.report.first()
    assert (rep.n_units, rep.n_failed) == (3, 2)
    assert os.listdir(local_path(root + "/ok")) == ["r_01.csv"]
    assert os.listdir(local_path(root + "/err")) == ["r_02.csv"]
    audit = read_cycles(spark, root + "/audit").collect()
    assert sorted((r.billcycle, r.rownumber) for r in audit) == [("BC01", 3), ("BC01", 4)]


def test_file_names_with_special_characters(spark, scratch):
    import os
    from sluice.operators.audit import audit_columns
    from sluice.plans.text import parse_text
    root = scratch("names")
    names = ["a b_01.txt", "x+y%z_02.txt", "é_03.txt"]
    write_text_files(root + "/in", {n: "D\t1\n" for n in names})
    a = audit_columns(parse_text(spark, root + "/in", 2))
    assert sorted((r.filename, r.billcycle) for r in a.collect()) == sorted(
        [("a b_01.txt", "BC01"), ("x+y%z_02.txt", "BC02"), ("é_03.txt", "BC03")])
    rows = parse_text(spark, root + "/in", 2)
    d = file_disposition(spark, spark.read.text(root + "/in").inputFiles(), rows)
    assert sorted((r.filename, r.status, r.n_rows) for r in d.collect()) == sorted(
        [(n, "processed", 1) for n in names])
    q = stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", text_audit_rows(2),
                       processed=root + "/done")
    q.awaitTermination()
    assert sorted(os.listdir(local_path(root + "/done"))) == sorted(names)
    assert spark.read.parquet(root + "/sink").count() == 3


def test_run_text_job_end_to_end(spark, scratch):
    import os
    from sluice.plans.jobs import run_text_job
    root = scratch("textjob")
    write_text_files(root + "/in", {"g_01.txt": "D\t1\nH\t2\n", "g_02.txt": "D\t3\n"})
    loc = scratch("textjob-tbl")
    spark.sql(f"CREATE TABLE t_textjob (column1 string, column2 string, RN bigint) "
              f"USING parquet LOCATION '{loc}'")
    res = run_text_job(spark, root + "/in/*.txt", 2, "t_textjob", audit_path=root + "/audit",
                       processed=root + "/ok", error=root + "/err", row_number_label="rn",
                       filter_record_type="D")
    assert sorted(tuple(r) for r in spark.table("t_textjob").collect()) == [
        ("D", "1", 1), ("D", "3", 2)]
    assert (res.report.first().n_units, res.report.first().n_failed) == (2, 0)
    assert sorted(os.listdir(local_path(root + "/ok"))) == ["g_01.txt", "g_02.txt"]
    audit = sorted((r.billcycle, r.rownumber, r.column2)
                   for r in read_cycles(spark, root + "/audit").collect())
    assert audit == [("BC01", 1, "1"), ("BC02", 1, "3")]


def test_failed_load_is_an_outcome_and_files_move(spark, scratch):
    import os
    from sluice.plans.jobs import run_text_job
    root = scratch("job-fail")
    write_text_files(root + "/in", {"a_01.txt": "x\t1\n", "b_02.txt": "y\tn/a\n"})
    write_text_files(root + "/err", {"a_01.txt": "an older copy"})
    spark.sql(f"CREATE TABLE t_jfail (COLUMN1 string, COLUMN2 int) USING parquet "
              f"LOCATION '{scratch('jfail')}'")
    res = run_text_job(spark, [root + "/in/*.txt"], 2, "t_jfail", processed=root + "/ok",
                       error=root + "/err")
    got = {r.filename: r.status for r in res.outcomes.collect()}
    assert got == {"a_01.txt": "database_error", "b_02.txt": "database_error"}
    assert json.loads(res.outcomes.first().payload)["status"] == "database_error"
    assert spark.table("t_jfail").count() == 0
    assert sorted(os.listdir(local_path(root + "/err"))) == ["a_01.txt", "b_02.txt"]
    assert os.listdir(local_path(root + "/in")) == []


def test_stream_quarantines_one_bad_file(spark, scratch):
    import os
    from sluice.fixtures import build_workbook
    from sluice.streaming.inbound import report_audit_rows
    root = scratch("stream-bad")
    folder = local_path(root + "/inbound")
    os.makedirs(folder)
    for i in range(1, 5):
        data = b"broken" if i == 3 else build_workbook([["Account No", "Name"], [str(i), "n"]])
        with open(os.path.join(folder, f"r_{i:02d}.xlsx"), "wb") as f:
            f.write(data)
    q = stream_inbound(spark, root + "/inbound", root + "/sink", root + "/_ck",
                       report_audit_rows("Account No, Name", kind="xlsx"), processed=root + "/ok",
                       error=root + "/err", pattern="*.xlsx")
    q.awaitTermination()
    assert sorted(os.listdir(local_path(root + "/ok"))) == ["r_01.xlsx", "r_02.xlsx", "r_04.xlsx"]
    assert os.listdir(local_path(root + "/err")) == ["r_03.xlsx"]
    assert sorted(r["Account No"] for r in spark.read.parquet(root + "/sink").collect()) == ["1", "2", "4"]


def test_good_files_of_a_cycle_stay_together_beside_a_bad_one(spark, scratch):
    import os
    root, rows = scratch("stream-cycle"), text_audit_rows(2)
    write_text_files(root + "/in", {"a_01.txt": "D\t1\n", "b_01.txt": "D\t2\n",
                                    "bad_01.txt": "D\t3\n", "c_02.txt": "D\t4\n"})

    def to_rows(session, paths):
        if any("bad_" in p for p in paths):
            raise ValueError("bad file")
        return rows(session, paths)

    q = stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", to_rows,
                       processed=root + "/done", error=root + "/err", key="billcycle")
    q.awaitTermination()
    got = sorted(r.column2 for r in spark.read.parquet(root + "/sink").collect())
    assert got == ["1", "2", "4"]
    assert sorted(os.listdir(local_path(root + "/done"))) == ["a_01.txt", "b_01.txt", "c_02.txt"]
    assert os.listdir(local_path(root + "/err")) == ["bad_01.txt"]


def _intake(spark, root, calls, **options):
    rows = text_audit_rows(2)

    def to_rows(session, paths):
        calls.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        if any("bad" in open(local_path(p)).read() for p in paths):
            raise ValueError("bad file")
        return rows(session, paths)

    q = stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", to_rows, **options)
    q.awaitTermination()
    return sorted((r.filename, r.column2) for r in spark.read.parquet(root + "/sink").collect())


def test_stream_loads_a_resent_file_again_and_an_unchanged_one_once(spark, scratch):
    import os
    root, calls = scratch("stream-resent"), []
    write_text_files(root + "/in", {"a_01.txt": "D\t1\nD\t2\n", "b_01.txt": "D\t3\n"})
    first = [("a_01.txt", "1"), ("a_01.txt", "2"), ("b_01.txt", "3")]
    assert _intake(spark, root, calls) == first
    assert _intake(spark, root, calls) == first          # files stay, listed again, not loaded
    path = write_text_files(root + "/in", {"a_01.txt": "D\t9\n"})[0]
    assert _intake(spark, root, calls) == [("a_01.txt", "9"), ("b_01.txt", "3")]
    os.utime(path, (1, 1))                               # same length, another (older) time
    assert _intake(spark, root, calls) == [("a_01.txt", "9"), ("b_01.txt", "3")]
    assert calls == [["a_01.txt", "b_01.txt"], ["a_01.txt"], ["a_01.txt"]]


def test_stream_moves_an_unchanged_file_without_loading_it(spark, scratch):
    import os
    import shutil
    root, calls = scratch("stream-same"), []
    path = write_text_files(root + "/in", {"a_01.txt": "D\t1\n"})[0]
    shutil.copy2(path, local_path(root) + "/kept")
    _intake(spark, root, calls, processed=root + "/done")
    shutil.copy2(local_path(root) + "/kept", path)       # the same file with its time
    assert _intake(spark, root, calls, processed=root + "/done") == [("a_01.txt", "1")]
    assert calls == [["a_01.txt"]] and os.listdir(local_path(root + "/in")) == []


def test_a_stopped_stream_forgets_the_version_it_could_not_load(spark, scratch):
    root, calls = scratch("stream-stopped"), []
    write_text_files(root + "/in", {"a_01.txt": "D\t1\n"})
    _intake(spark, root, calls)
    write_text_files(root + "/in", {"a_01.txt": "bad\t22\n"})
    with pytest.raises(Exception, match="bad file"):
        _intake(spark, root, calls)
    write_text_files(root + "/in", {"a_01.txt": "D\t333\n"})
    assert _intake(spark, root, calls) == [("a_01.txt", "333")]


def test_state_has_no_more_partitions_than_a_batch_has_files(spark, scratch):
    root, key = scratch("stream-state"), "spark.sql.shuffle.partitions"
    write_text_files(root + "/in", {f"f{i}_01.txt": f"D\t{i}\n" for i in range(5)})
    session, rows = spark.conf.get(key), text_audit_rows(2)
    seen = []

    def to_rows(session, paths):
        seen.append((session.conf.get(key), len(paths)))
        return rows(session, paths)

    def intake(n):
        q = stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", to_rows,
                           max_files_per_trigger=n)
        q.awaitTermination()
        assert spark.conf.get(key) == session
        return [p.stateOperators[0].numShufflePartitions for p in q.recentProgress
                if p.stateOperators]

    assert set(intake(2)) == {2} and int(session) > 2
    assert sum(n for _, n in seen) == 5 and {s for s, _ in seen} == {session}
    assert set(intake(100)) == {2} and sum(n for _, n in seen) == 5      # known to its state
    assert sorted(r.column2 for r in spark.read.parquet(root + "/sink").collect()) == list("01234")


def test_a_running_stream_lists_its_folder_again(spark, scratch):
    import time
    root = scratch("stream-running")
    write_text_files(root + "/in", {"a_01.txt": "D\t1\n"})
    q = stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", text_audit_rows(2),
                       available_now=False, every_seconds=1)

    def wait_for(want):
        for _ in range(120):
            try:
                got = sorted(r.column2 for r in spark.read.parquet(root + "/sink").collect())
            except Exception:  # noqa: BLE001 - not there yet, or being replaced
                got = None
            if got == want:
                return
            time.sleep(0.5)
        raise AssertionError((got, q.exception()))

    try:
        wait_for(["1"])
        write_text_files(root + "/in", {"a_01.txt": "D\t22\n", "b_02.txt": "D\t3\n"})
        wait_for(["22", "3"])
    finally:
        q.stop()


def _moving(spark, folder):
    write_text_files(folder + "/in", {"ok.csv": "1\n", "a b%.csv": "22\n", "bad.csv": "333\n"})
    uri = "file:" + local_path(folder) + "/in/"
    return spark.createDataFrame(
        [(uri + "ok.csv", "processed"), (uri + "a b%.csv", "processed"),
         (uri + "bad.csv", "empty_data"), (uri + "gone.csv", "processed"),
         (uri + "never.csv", "missing_file")], "path string, status string")


def _tree(folder):
    import os
    return sorted(os.path.relpath(os.path.join(d, n), local_path(folder))
                  for d, _, names in os.walk(local_path(folder)) for n in names)


def test_moves_are_made_by_tasks_once(spark, scratch):
    from sluice.operators import report as R
    from sluice.sources.files import task_version
    folder = scratch("task-moves")
    out = _moving(spark, folder)
    moved = R.move_by_outcome(spark, out, folder + "/done", folder + "/err")
    got = {r.path.rsplit("/", 1)[-1]: (r.status, r.moved_to, r.move_error) for r in moved.collect()}
    assert set(got) == {"ok.csv", "a b%.csv", "bad.csv", "gone.csv"}
    assert got["a b%.csv"][1] == folder + "/done/a b%.csv"
    assert got["gone.csv"][1] is None and "FileNotFound" in got["gone.csv"][2]
    assert _tree(folder) == ["done/a b%.csv", "done/ok.csv", "err/bad.csv"]
    assert moved.count() == 4                              # reading the result moves nothing

    # a task that is run again: moved files are found by their targets
    write_text_files(folder + "/in", {"ok.csv": "a re-sent one\n"})
    ok = out.first().path
    target = folder + "/done/ok.csv"
    length, modified = task_version(target)
    intents = spark.createDataFrame(
        [(ok, "processed", target, length, modified)], R.INTENT_SCHEMA).toArrow().to_batches()
    again = [r for b in R._moves(intents) for r in b.to_pylist()]
    assert [r["moved_to"] for r in again] == [target] and again[0]["move_error"] is None
    assert open(local_path(folder) + "/in/ok.csv").read() == "a re-sent one\n"
    assert open(local_path(target)).read() == "1\n"
    # the next run takes the re-sent file and replaces the one of that name
    R.move_by_outcome(spark, out.limit(1), folder + "/done", folder + "/err").collect()
    assert open(local_path(target)).read() == "a re-sent one\n"


def test_a_failed_move_of_a_failed_file_is_a_cascading_failure(spark, scratch):
    from sluice.operators import report as R
    folder = scratch("task-moves-fail")
    out = _moving(spark, folder)
    write_text_files(folder, {"blocked": "a file, not a folder"})
    moved = {r.path.rsplit("/", 1)[-1]: r for r in R.move_by_outcome(
        spark, out, folder + "/done", folder + "/blocked").collect()}
    assert moved["bad.csv"].status == "cascading_failure" and moved["bad.csv"].move_error
    assert moved["ok.csv"].status == "processed" and moved["ok.csv"].moved_to
    assert "in/bad.csv" in _tree(folder)


def test_stores_that_tasks_cannot_reach_are_moved_by_the_driver(spark, scratch, monkeypatch):
    from sluice.operators import report as R
    folder = scratch("driver-moves")
    out = _moving(spark, folder)
    monkeypatch.setattr(R, "TASK_SCHEMES", ("nothing",))
    moved = R.move_by_outcome(spark, out.filter("path NOT LIKE '%gone%'"), folder + "/done",
                              folder + "/err").collect()
    assert len(moved) == 3 and all(r.moved_to for r in moved)
    assert [n for n in _tree(folder) if not n.endswith(".crc")] == [
        "done/a b%.csv", "done/ok.csv", "err/bad.csv"]


@pytest.mark.parametrize("key", ["billcycle", ("billcycle", "filename")])
def test_a_versioned_sink_takes_each_micro_batch_as_one_commit(spark, scratch, key):
    from sluice.sinks.cycles import last_version
    root, rows = scratch("stream-versioned"), text_audit_rows(2)
    write_text_files(root + "/in", {"a_01.txt": "D\t1\n", "b_01.txt": "D\t2\n", "bad_02.txt": "x\n"})

    def to_rows(session, paths):
        if any("bad_" in p for p in paths):
            raise ValueError("bad file")
        return rows(session, paths)

    def intake():
        stream_inbound(spark, root + "/in", root + "/sink", root + "/_ck", to_rows, key=key,
                       processed=root + "/ok", error=root + "/err",
                       versioned=True).awaitTermination()
        return sorted(r.column2 for r in read_cycles(spark, root + "/sink").collect())

    assert intake() == ["1", "2"]
    write_text_files(root + "/in", {"a_01.txt": "D\t7\n"})
    assert intake() == (["7"] if key == "billcycle" else ["2", "7"])
    assert last_version(spark, root + "/sink") == (2 if key == "billcycle" else 3)
