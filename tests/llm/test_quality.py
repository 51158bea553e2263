import numpy as np
import pytest
from conftest import SF_SMALL
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F
from sluice.llm import quality as M


def test_passages_of_each_text_are_its_own():
    texts = ["a b c", None, "", " ".join(["word"] * 130), "x" * 5000, "\n\t ", "é ß"]
    x, n = M.passages(texts)
    assert n.tolist() == [1, 1, 1, 3, 1, 1, 1] and x.shape == (9, M.FEATURES)
    assert not x[1].any() and not x[2].any() and not x[7].any()
    for i, t in enumerate(texts):  # one at a time gives the same rows
        alone, k = M.passages([t])
        at = n[:i].sum()
        np.testing.assert_array_equal(alone, x[at:at + n[i]])


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, n, y = rng.random((9, M.FEATURES)), np.array([2, 3, 4]), np.array([1.0, 0.0, 1.0])
    model = M.Model()

    def loss():
        s = model.forward(x, n)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grad = model.gradients(model.forward(x, n), n, y)
    for k, g in grad.items():
        flat, step = model.p[k].reshape(-1), 1e-6
        for i in rng.integers(0, flat.size, 5):
            flat[i] += step
            up = loss()
            flat[i] -= 2 * step
            down = loss()
            flat[i] += step
            assert g.reshape(-1)[i] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_held_out_labels(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    y = {r.doc_id: r.quality for r in labels.collect()}
    rows = M.evaluate(df, labels).collect()
    assert len(rows) == df.count()
    held = [r for r in rows if r.held_out and r.doc_id in y]
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_edges(spark, docs):
    df = docs([(1, "fine text here"), (1, "fine text here"), (2, None), (None, ""), (3, "%%% ###"),
               (4, "w " * 20_000)]).selectExpr("*", "1 AS key", "2 AS score")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (2, None), (4, 7), (9, 1)],
                                   "doc_id long, quality int")
    model = M.train(df, labels)
    rows = M.score(df, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    one, other = (r.score for r in rows if r.doc_id == 1)
    assert one == pytest.approx(other, abs=1e-12)
    none = M.train(df, labels.limit(0))
    assert {r.score for r in M.score(df, none).collect()} == {0.5}
    assert M.score(df.limit(0), model).count() == 0


def test_a_long_text_leaves_the_others_in_the_sample(spark, docs):
    keys = [r.doc_id for r in spark.range(40).withColumnRenamed("id", "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    assert M.fitting([(1, 99), (2, 1), (3, 100), (4, 1)], 100) == [2, 4]
    assert M.fitting([(1, 60), (2, 1), (3, 40), (4, 39)], 100) == [2, 1, 4]
    rows = [(k, ("good words in a row. " if k % 2 else "%% || ## 77 ") * 3) for k in keys]
    labels = spark.createDataFrame([(k, k % 2) for k in keys], "doc_id long, quality int")
    long = [(keys[0], "x " * 10_000), *rows[1:]]  # the first in hash order does not fit
    model = M.train(docs(long), labels, sample_bytes=10_000)
    got = {r.doc_id: r.score for r in M.score(docs(rows), model).collect()}
    assert all((got[k] > 0.5) == (k % 2 == 1) for k in keys)
    whole = M.train(docs(rows[1:]), labels)
    assert all((model.p[k] == whole.p[k]).all() for k in model.p)
