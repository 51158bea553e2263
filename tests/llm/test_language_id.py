import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_fixtures import docs  # noqa: F401
from sluice.llm import language_id as L


def test_grams_are_padded_words():
    mark = "_"
    words = ["_ab_", "_c_"]
    want = sorted([c for w in words for c in w.strip(mark)]
                  + [w[i:i + 2] for w in words for i in range(len(w) - 1)]
                  + [w[i:i + 3] for w in words for i in range(len(w) - 2)])
    def text(code):
        out = ""
        while code:
            out, code = chr(code & 0x1FFFFF) + out, code >> 21
        return out
    assert sorted(map(text, L.grams("Ab, 7 c!").tolist())) == want


def test_distance_is_out_of_place():
    a, b, c = (L.grams(x)[0] for x in "abc")
    judge = L.Judge({"x": [int(a), int(b)], "y": [int(c)]}, size=10)
    own = L.ranking("a", 10).tolist()  # single letters first, then pairs and triples
    off = sum(abs(own.index(g) - [a, b].index(g)) if g in (a, b) else 10 for g in own)
    assert judge("a") == ("x", pytest.approx(1 - off / (10 * len(own))))


def test_unknown_texts_and_ties(spark, docs):
    df = docs([(1, "the cat the dog", "en"), (2, None, "en"), (3, "", "en"), (4, "12 !?", "en"),
               (5, "zzz", None), (1, "the cat the dog", "en"), (None, "the the", "en"),
               (6, "the cat the dog", "fr")])
    df = df.selectExpr("*", "0 AS score", "'q' AS key")
    learned = L.profiles(df)
    assert set(learned) == {"en", "fr"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(df, learned).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[1][0] == "en" and 0 < got[1][1] <= 1
    assert L.identify(df, learned).count() == 8
    assert L.identify(df.limit(0), learned).count() == 0
    assert L.profiles(df.limit(0)) == {} and L.identify(df, {}).filter("lang_pred <> 'und'").count() == 0


def test_profiles_count_everything(spark, docs):
    df = docs([(i, "ab ab abc", "x") for i in range(50)])
    assert L.profiles(df)["x"] == L.ranking("ab ab abc").tolist()


def test_held_out_accuracy_and_rejections(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lang = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    rows = L.evaluate(df).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.99 * len(held)
    strange = spark.createDataFrame([(-1, "你好世界", "", "", 0)], df.schema)
    kept = L.keep(df.union(strange), L.profiles(df))
    assert kept.columns == df.columns and kept.count() == df.count()
    assert kept.filter("doc_id = -1").count() == 0


def test_long_texts_are_counted_in_stretches(monkeypatch):
    import random
    rng = random.Random(3)
    abc = "abcdeABÉéΣσßİ日 \n\t.,'1_"
    for _ in range(300):
        text = "".join(rng.choice(abc) for _ in range(rng.randrange(0, 400)))
        want = np.unique(L.grams(text), return_counts=True)
        for length in (1, 7, 100):
            parts = list(L.stretches(text, length))
            assert "".join(parts) == text
            monkeypatch.setattr(L.stretches, "__defaults__", (length,))
            got = L.counted(text)
            assert all(np.array_equal(a, b) for a, b in zip(got, want)), text
