import random

from pyspark.sql import functions as F

from sluice.operators import headers as H
from sluice.operators.stamp import FILE_COL, ROW_COL
from sluice.plans import headed as HP


# --- an independent statement of the header rules, used as the test oracle --------------
def _n(v):
    if v is None:
        return ""
    s = " ".join(str(v).split())
    return "" if s.lower() == "none" else s


def _k(s):
    return s.lower().replace(" ", "").replace("-", "")


def _score(a, b):
    if a == b:
        return 1.0
    if b in a or a in b:
        return 0.8
    return 0.7 if len(set(a) & set(b)) >= 3 else 0.0


def spec_detect(rows, targets):
    """(assigned count, last header row index, {column: target}) of the winning block."""
    import itertools

    sample = rows[:50]
    width = max(map(len, sample), default=0)
    fits = [(s, h) for s, h in itertools.product(range(15), range(1, 10)) if s + h <= len(sample)]

    def assign(block):
        s, h = block
        cols = {c: " ".join(filter(None, (_n(r[c]) if c < len(r) else "" for r in sample[s:s + h])))
                for c in range(width)}
        pairs = [(_score(_k(text), _k(th)), c, ti, th) for c, text in cols.items() if text
                 for ti, th in enumerate(targets)]
        pairs = [p for p in pairs if p[0] >= 0.7]
        pairs.sort(key=lambda p: (-p[0], p[1], p[2]))
        chosen = {}
        for _, c, ti, th in pairs:
            if c not in chosen and ti not in {t for t, _ in chosen.values()}:
                chosen[c] = (ti, th)
        return {c: th for c, (_, th) in chosen.items()}

    results = [(assign(b), b) for b in fits]
    top = max((len(m) for m, _ in results), default=0)
    if top == 0:
        return 0, -1, {}
    mapping, (s, h) = next((m, b) for m, b in results if len(m) == top)
    return top, s + h - 1, mapping


WORDS = ["Account No", "Name", "Customer", "Customer Name", "Account Balance", "Balance",
         "Segment", "Market", "Market Segment", "Note", "-", "--", "none", "NONE", "", " ",
         None, "Monthly Statement", "Page 1", "12.50", "x", "Cust-omer  Name", "acct",
         "Report", "Total", "Branch 7"]
TARGETS = H.parse_headers("Account No, Customer Name, Account Balance, Market Segment, Note")


def _grid_df(spark, grids):
    rows = [(f"g{i:03d}", r + 1, cells) for i, g in enumerate(grids) for r, cells in enumerate(g)]
    return spark.createDataFrame(rows, f"{FILE_COL} string, {ROW_COL} long, cells array<string>")


def test_detection_matches_spec_on_random_grids(spark):
    rnd = random.Random(7)
    grids = []
    for _ in range(120):
        n_rows = rnd.randint(1, 24)
        width = rnd.randint(1, 6)
        grids.append([[rnd.choice(WORDS) for _ in range(width)] for _ in range(n_rows)])
    det = H.detect_headers(H.sample_reports(_grid_df(spark, grids)), TARGETS)
    got = {r[FILE_COL]: (r["n"], r["header_end"], {m["c"]: m["th"] for m in r["mapping"]})
           for r in det.collect()}
    for i, g in enumerate(grids):
        n, end, mapping = spec_detect(g, TARGETS)
        assert got[f"g{i:03d}"] == (n, end if n else -1, mapping), (i, g)


def test_assignment_is_one_to_one_and_scores_descending(spark):
    rnd = random.Random(3)
    grids = [[[rnd.choice(WORDS) for _ in range(5)] for _ in range(12)] for _ in range(20)]
    w = H.header_windows(H.sample_reports(_grid_df(spark, grids)))
    a = H.assign_headers(H.header_scores(w, TARGETS)).collect()
    for r in a:
        cs = [m["c"] for m in r["mapping"]]
        ts = [m["t"] for m in r["mapping"]]
        assert len(cs) == len(set(cs)) and len(ts) == len(set(ts))
        scores = [m["score"] for m in r["mapping"]]
        assert scores == sorted(scores, reverse=True)


def test_trap_dash_row_wins_like_reference(spark):
    # T5: a row of dashes canonicalises to '' and is "contained" in every header.
    grid = [["-", "-", "-"], ["Account No", "Customer Name", "Note"], ["1", "a", "b"]]
    det = H.detect_headers(H.sample_reports(_grid_df(spark, [grid])), TARGETS).first()
    assert (det["n"], det["header_end"]) == spec_detect(grid, TARGETS)[:2]
    assert det["header_end"] == 0


def test_trap_two_row_header_stops_at_first_row(spark):
    # The first of two header rows alone already matches every target.
    targets = H.parse_headers("Account No, Account Balance, Account Type")
    grid = [["Account", "Account", "Account"], ["No", "Balance", "Type"], ["1", "2", "3"]]
    det = H.detect_headers(H.sample_reports(_grid_df(spark, [grid])), targets).first()
    assert det["n"] == 3 and det["header_end"] == spec_detect(grid, targets)[1] == 0


def test_repeated_targets_used_once():
    assert H.parse_headers(" A ,a, A,, none , B") == ["A", "a", "B"]


def test_headed_end_to_end_with_footers_and_blanks(spark):
    grid = [["Report", "", ""], ["Account No", "Customer Name", "Note"],
            ["1", " Ann ", ""], ["", "", ""], ["2", "Bo", "Page 3"], ["3", "Cy", " "],
            ["Generated by x", "", ""]]
    res = HP.headed(_grid_df(spark, [grid]), "Account No, Customer Name")
    rows = res.data.orderBy(ROW_COL).collect()
    assert [(r["Account No"], r["Customer Name"], r[ROW_COL]) for r in rows] == \
        [("1", "Ann", 3), ("3", "Cy", 6)]


def test_no_match_means_no_rows_and_header_end_minus_one(spark):
    grid = [["zz", "qq"], ["1", "2"]]
    res = HP.headed(_grid_df(spark, [grid]), "Account No")
    assert res.data.count() == 0
    assert res.detected.first()["header_end"] == -1


def test_detection_plan_stays_on_executors(spark):
    grids = [[["Account No", "x"], ["1", "2"]]] * 3
    det = H.detect_headers(H.sample_reports(_grid_df(spark, grids)), TARGETS)
    plan = det._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_strict_mode_fixes_dash_row_and_two_row_header(spark):
    grid = [["-", "-", "-"], ["Account No", "Customer Name", "Note"], ["1", "a", "b"]]
    det = H.detect_headers(H.sample_reports(_grid_df(spark, [grid])), TARGETS, strict=True).first()
    assert det["header_end"] == 1
    targets = H.parse_headers("Account No, Account Balance, Account Type")
    grid2 = [["Account", "Account", "Account"], ["No", "Balance", "Type"], ["1", "2", "3"]]
    det2 = H.detect_headers(H.sample_reports(_grid_df(spark, [grid2])), targets, strict=True).first()
    assert det2["n"] == 3 and det2["header_end"] == 1


def test_min_score_excludes_shared_letter_matches(spark):
    grid = [["Monthly Statement", ""], ["Account No", "Note"], ["1", "x"]]
    loose = H.detect_headers(H.sample_reports(_grid_df(spark, [grid])), TARGETS).first()
    tight = H.detect_headers(H.sample_reports(_grid_df(spark, [grid])), TARGETS,
                             min_score=0.8).first()
    assert all(m["score"] >= 0.8 for m in tight["mapping"])
    assert any(m["score"] == 0.7 for m in loose["mapping"]) or loose["n"] >= tight["n"]


def test_footer_phrases_parameter(spark):
    # The default phrase "page " also drops a legitimate row such as "Homepage x".
    grid = [["Account No", "Note"], ["1", "Homepage x"], ["2", "ok"]]
    default = HP.headed(_grid_df(spark, [grid]), "Account No")
    assert sorted(r["Account No"] for r in default.data.collect()) == ["2"]
    narrowed = HP.headed(_grid_df(spark, [grid]), "Account No",
                         footer_phrases=("page 1 of", "run time"))
    assert sorted(r["Account No"] for r in narrowed.data.collect()) == ["1", "2"]


def test_target_names_with_dots_and_spaces(spark):
    from sluice.operators.align import align
    from sluice.operators.audit import audit_columns
    grid = [["Acct. No", "Full Name"], ["7", "Ann"]]
    res = HP.headed(_grid_df(spark, [grid]), "Acct. No, Full Name")
    row = res.data.first()
    assert (row["Acct. No"], row["Full Name"]) == ("7", "Ann")
    out = align(audit_columns(res.data), ["ACCT. NO", "rownumber"]).first()
    assert tuple(out) == ("7", 2)


# --- the joint pre-pass of CSV reports ----------------------------------------------------
CSV_TEXT = {
    "plain.csv": "Title\n\nAccount No,Name\n1,a\n2,b\n",
    "wide.csv": "﻿Account No,Name,Balance,More\n" + "".join(
        f'{i},"n, {i}",{i}.50,"q""{i}"\n{"" if i % 3 else "   "}\n' for i in range(300)),
    "late.csv": "\n \x01\n\t\n" + "x\n" * 10 + "Account No;No,Name\n" + ",,\n" * 40 + "7,z\n",
    "blank.csv": "\n\n  \n",
    "empty.csv": "",
    "odd.csv": '"Account No",Name\n"open,1\n\'q\',2,3,"",\n,,,\n \n',
}


def _csv_folder(scratch, name):
    from conftest import write_text_files
    folder = scratch(name)
    write_text_files(folder, CSV_TEXT)
    return folder


def test_pre_pass_gives_the_rows_of_the_csv_reader(spark, scratch):
    from sluice.sources.csv import infer_width, pre_pass, read_csv_grid
    folder = _csv_folder(scratch, "pre-pass")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    for size in (old, "512"):
        spark.conf.set(key, size)
        try:
            known = pre_pass(spark, folder, sample=50)
            grid = HP.csv_grid(spark, folder, known=known)
            want = {(r[FILE_COL], r[ROW_COL]): r.cells for r in grid.collect()}
            got = {(r[FILE_COL], r[ROW_COL]): r.cells for r in known.first_rows(50).collect()}
            plain = HP.csv_grid(spark, folder, width=infer_width(spark, folder))
            assert {(r[FILE_COL], r[ROW_COL]): r.cells for r in plain.collect()} == want
            assert known.splits.count() > len(CSV_TEXT) or size == old
        finally:
            spark.conf.set(key, old)
        assert known.width == infer_width(spark, folder) == 5
        assert got == {k: c for k, c in want.items() if k[1] <= 50}
        by_file = {}
        for f, n in want:
            by_file.setdefault(f.rsplit("/", 1)[-1], []).append(n)
        assert {f: len(n) for f, n in by_file.items()} == {
            "plain.csv": 4, "wide.csv": 301, "late.csv": 52, "odd.csv": 5}
        assert all(sorted(n) == list(range(1, len(n) + 1)) for n in by_file.values())
    assert read_csv_grid(spark, folder, width=5).count() == len(want)


def test_csv_reports_are_read_twice_in_all(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameReader
    folder, made = _csv_folder(scratch, "two-scans"), []
    for kind in ("text", "csv"):
        real = getattr(DataFrameReader, kind)
        monkeypatch.setattr(DataFrameReader, kind, lambda self, *a, _r=real, _k=kind, **k: (
            made.append(_k), _r(self, *a, **k))[1])
    res = HP.ingest_csv(spark, folder, "Account No, Name")       # of unknown width
    plan = res.data._jdf.queryExecution().executedPlan().toString()
    assert made == ["text", "csv"]
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
    got = {}
    for r in res.data.collect():
        got.setdefault(r.filename, []).append((r["Account No"], r["Name"]))
    assert got["plain.csv"] == [("1", "a"), ("2", "b")] and len(got["wide.csv"]) == 300
    assert got["late.csv"] == [("7", "z")]


def test_no_csv_rows_at_all(spark, scratch):
    from conftest import write_text_files
    folder = scratch("no-rows")
    write_text_files(folder, {"a.csv": "", "b.csv": "\n \n"})
    res = HP.ingest_csv(spark, folder, "Account No")
    assert res.data.count() == 0 and res.detected.count() == 0
