"""The pipeline against brute force, on the smoke tables with planted documents."""

import corpus_pipeline as P
import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F
from sluice.llm import decontaminate, language_id
from test_decontaminate import distance
from test_line_dedup import brute_force as dropped_lines
from test_minhash import brute_force as component_of
from test_mixing import targets


@pytest.fixture(scope="module")
def folder(spark):
    from sluice.session import scratch_path

    path = scratch_path(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet")
    item = items.orderBy("item_id").first().text
    own = docs.orderBy(F.length("text").desc()).first().text.replace("\n", " ")
    words = own.split()[:300]
    planted = [(9001, "你好 世界", "en", "src1"), (9002, "12 % !", "en", "src1"), (9003, None, "en", None),
               (9004, "before " + item[:40] + "x" + item[41:] + " after", "en", "src2"),
               (9005, " ".join(words), "en", "src3"),
               (9006, " ".join(words[:150] + ["changed"] + words[151:]), "en", "src3")]
    extra = spark.createDataFrame([(*r, len(r[1] or "")) for r in planted], docs.schema)
    docs.union(extra).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    now, names = docs, [n for n, _ in P.STAGES]
    assert names == ["language_id", "line_dedup", "minhash_dedup", "decontamination", "mixing"]
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()]
        after = P.cut(stage(spark, now, folder), f"test-{name}")
        got = {r.doc_id: r for r in after.collect()}
        text = dict(before)
        if name != "mixing":
            assert after.schema.simpleString() == now.schema.simpleString()
        if name == "language_id":
            judge = language_id.Judge(language_id.profiles(now))
            want = {k: t for k, t in before if judge(t)[0] != "und" and judge(t)[1] >= 0.2}
            assert not {9001, 9002, 9003} & set(want) and len(want) == len(before) - 3
        elif name == "line_dedup":
            lost = dropped_lines(before)
            kept = {k: [x for i, x in enumerate(t.split("\n")) if i not in lost[k]] for k, t in before}
            want = {k: "\n".join(v) for k, v in kept.items() if v}
            assert all(r.n_chars == len(r.text) for r in got.values())
        elif name == "minhash_dedup":
            root = dict(zip((k for k, _ in before), component_of(before)))
            want = {k: t for k, t in before if root[k] == k}
            assert {9005, 9006} & set(text) and len({9005, 9006} & set(want)) == 1
        elif name == "decontamination":
            def leaks(t):
                return any(distance(p, decontaminate.normalise(t)) <= len(p) // 10
                           for p in map(decontaminate.normalise, items) if near(p, t))
            def near(p, t):  # the plain table only where some stretch of the item occurs
                k = len(p) // 10 + 1
                return any(p[len(p) * i // k:len(p) * (i + 1) // k] in decontaminate.normalise(t)
                           for i in range(k))
            want = {k: t for k, t in before if not leaks(t)}
            assert 9004 in text and 9004 not in want
        else:
            sizes, source, taken = {}, {r.doc_id: r.source for r in now.collect()}, {}
            for k, t in before:
                sizes[source[k]] = sizes.get(source[k], 0) + len((t or "").split())
                if k in got:
                    n = len((t or "").encode().split()) * got[k].copies
                    taken[source[k]] = taken.get(source[k], 0) + n
                    assert 1 <= got[k].copies <= 3
            for s, target in targets(sizes).items():
                longest = max(len((t or "").split()) for k, t in before if source[k] == s)
                assert abs(taken.get(s, 0) - target) <= max(1, longest / 2)
            want = {k: text[k] for k in got}
        assert {k: r.text for k, r in got.items()} == want, name
        now = after


def test_run_and_its_query(spark, folder):
    import __spark_entry__ as E

    out = E.queries()["pipeline"](spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]
    assert out.count() > 0 and "pipeline" not in E.oracle_sql()


def test_empty_tables(spark, folder):
    from sluice.session import scratch_path

    path = scratch_path(spark, "pipeline-empty")
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{path}/{t}.parquet")
    assert P.run(spark, path).count() == 0
