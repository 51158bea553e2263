import random

import pytest
from conftest import SF_SMOKE
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F
from sluice.llm import line_dedup as M


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def brute_force(rows, tau=2, least=32):
    """Dropped line numbers per row of distinct ids."""
    seen, out = [], {}
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        out[key] = []
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" \t\x0b\x0c\r")
            if len(line) < least:
                continue
            if any(abs(len(x) - len(line)) <= tau and (x == line or levenshtein(x, line) <= tau)
                   for x in seen):
                out[key].append(n)
            if line not in seen:
                seen.append(line)
    return out


def edit(rng, line, n):
    chars = list(line)
    for _ in range(n):
        k, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars.insert(k, rng.choice("xyzé"))
        elif kind == 1:
            chars[k] = rng.choice("xyz\U0001f600")
        else:
            del chars[k]
    return "".join(chars)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_bit_parallel_distance(spark, tau):
    rng = random.Random(tau)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice("ab\U0001f600é") for _ in range(rng.randrange(3, 40)))
        pairs.append((a, edit(rng, a, min(rng.randrange(0, 6), len(a) - 1))))
    df = spark.createDataFrame(pairs, "a string, b string") \
        .filter(F.abs(F.length("a") - F.length("b")) <= tau)
    wrong = df.filter(M.within(F.col("a"), F.col("b"), tau) != (F.levenshtein("a", "b") <= tau))
    assert wrong.count() == 0
    lost = df.filter((F.levenshtein("a", "b") <= tau) & ~M.may_be_within(F.col("a"), F.col("b"), tau))
    assert lost.count() == 0


def test_edited_lines_match_brute_force(spark, docs):
    rng = random.Random(8)
    draw = lambda: "".join(rng.choice("abcdef ") for _ in range(rng.randrange(34, 60))).strip() + "q"
    origin = [draw() for _ in range(25)]
    rows = []
    for key in range(60):
        mine = [edit(rng, rng.choice(origin), rng.choice([0, 0, 1, 2, 3])) for _ in range(4)]
        rows.append((key, "\n".join(mine + [draw(), "short", "short"])))
    want = brute_force(rows)
    got = {r.doc_id: r for r in M.report(docs(rows)).collect()}
    for key, text in rows:
        assert got[key].dropped_lines == ",".join(map(str, want[key]))
        assert got[key].n_lines == 7 and got[key].n_kept == 7 - len(want[key])
    left = {r.doc_id: r.text for r in M.clean(docs(rows)).collect()}
    for key, text in rows:
        assert left[key] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[key])


def test_chain_drops_lines_near_any_earlier_one(spark, docs):
    line = "m" * 40
    rows = [(1, line), (2, "ab" + line[2:]), (3, "abcd" + line[4:]), (4, "abcdef" + line[6:]),
            (5, "n" * 40)]
    got = {r.doc_id: r.n_kept for r in M.report(docs(rows)).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1}


def test_edges(spark, docs):
    line = "one two three four five six seven eight"
    rows = [(1, line), (None, line + "!"), (2, None), (3, ""), (4, "\n\n" + "  " + line + "\r"),
            (5, "tiny\ntiny"), (6, "z" * 60_000), (7, "z" * 60_001), (8, line), (8, line),
            (9, "fresh words that no other document of this table has"),
            (9, "fresh words that no other document of this table has")]
    df = docs(rows).selectExpr("*", "1 AS mark", "2 AS lost", "3 AS of", "4 AS `at`", "5 AS `odd ``n`")
    got = sorted((str(r.doc_id), r.n_lines, r.dropped_lines) for r in M.report(df).collect())
    assert got == sorted([("None", 1, ""), ("1", 1, "0"), ("2", 0, ""), ("3", 1, ""),
                          ("4", 3, "2"), ("5", 2, ""), ("6", 1, ""), ("7", 1, "0"),
                          ("8", 1, "0"), ("8", 1, "0"), ("9", 1, ""), ("9", 1, "")])
    left = M.clean(df)
    assert left.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect() if r.doc_id != 6) == sorted(
        [("None", line + "!"), ("2", None), ("3", ""), ("4", "\n"), ("5", "tiny\ntiny"),
         ("9", rows[-1][1]), ("9", rows[-1][1])], key=lambda r: (r[0], str(r[1])))
    assert M.report(df.limit(0)).count() == 0 and M.clean(df.limit(0)).count() == 0


def test_smoke_table_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in df.collect()])
    got = {r.doc_id: r.dropped_lines for r in M.report(df).collect()}
    assert got == {k: ",".join(map(str, v)) for k, v in want.items()}


def test_admitted_rows_hold_all_wanted_ones(spark):
    rows = spark.range(-5000, 5000).select(F.xxhash64("id").alias("k"), "id")
    wanted = rows.filter("id % 7 = 0").select(F.col("k").alias("key"))
    exact = M._admitted(rows, F.col("k"), wanted)
    assert exact.columns == ["k", "id"] and exact.count() == wanted.count()
    some = M._admitted(rows, F.col("k"), wanted, 256)
    assert some.columns == ["k", "id"] and some.count() < 4000
    assert exact.exceptAll(some).count() == 0
    assert M._admitted(rows, F.col("k"), wanted.limit(0), 256).count() == 0


def test_little_that_is_broadcast_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    args = (docs, "doc_id", "text", M.TAU, M.MIN_CHARS)
    wide, narrow = M.near_classes(*args), M.near_classes(*args, most=4)
    assert sorted(map(str, wide[1].collect())) == sorted(map(str, narrow[1].collect()))


def test_text_is_hashed_once_and_good_lines_are_not_shuffled(spark, docs, monkeypatch):
    """A document's hash is taken below the split, and before the last join only lines of classes
    that lose a line are left."""
    lines = [chr(97 + i) * 40 + " of its own" for i in range(20)]
    rows = [(1, "\n".join(lines)), (2, "  " + lines[3] + "\t\n" + lines[4][:-1] + "\n\n" + " " * 40)]
    plan = M.lines(docs(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("xxhash64")
    seen, real = [], M._admitted

    def spy(table, *rest):
        seen.append(real(table, *rest))
        return seen[-1]

    monkeypatch.setattr(M, "_admitted", spy)
    got = {r.doc_id: r.dropped_lines for r in M.report(docs(rows)).collect()}
    assert got == {i: ",".join(map(str, n)) for i, n in brute_force(rows).items()}
    bad = [d for d in seen if "digest" in d.columns]
    assert len(bad) == 1 and bad[0].count() == 3
