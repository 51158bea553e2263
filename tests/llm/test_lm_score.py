import collections
import math
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL, SF_SMOKE
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F
from sluice.llm import lm_score as M


def log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


class Reference:
    """Context-tree weighting with dictionaries, one node at a time."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, collections.defaultdict(lambda: [0, 0])
        self.children = collections.defaultdict(set)
        for t in texts:
            for node, bit in self.decisions(b" ".join(M.tokens(t)) + M.END):
                for d in range(depth + 1):
                    context, bits = node
                    short = context[len(context) - d:]
                    self.n[short, bits][bit] += 1
                    if d:
                        self.children[short[1:], bits].add((short, bits))

    def decisions(self, seq):
        padded = M.END * self.depth + seq
        for i in range(self.depth, len(padded)):
            context, bits = padded[i - self.depth:i], ""
            for k in range(7, -1, -1):
                bit = padded[i] >> k & 1
                yield (context, bits), bit
                bits += str(bit)

    def weighted(self, node):
        own = log_kt(*self.n[node])
        if len(node[0]) == self.depth:
            return own
        below = sum(self.weighted(c) for c in self.children[node])
        return np.logaddexp(own, below) - math.log(2)

    def one(self, node, d=0):
        context, bits = node
        key = (context[len(context) - d:], bits)
        if key not in self.n:
            return 0.5
        a, b = self.n[key]
        guess = (b + 0.5) / (a + b + 1)
        if d == self.depth:
            return guess
        share = math.exp(log_kt(a, b) - math.log(2) - self.weighted(key))
        return share * guess + (1 - share) * self.one(node, d + 1)

    def score(self, text):
        out = 0
        for node, bit in self.decisions(b" ".join(M.tokens(text)) + M.END):
            p = self.one(node)
            out += math.log10(p if bit else 1 - p)
        return out


def fold(key):
    return zlib.crc32(str(key).encode()) % 5 == 1


def base(texts, text):
    c = collections.Counter(w for t in texts for w in [*M.tokens(t), None])
    n, v = sum(c.values()), len(c)
    ws = [*M.tokens(text), None]
    return (sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), len(ws),
            sum(c[w] > 0 for w in ws), n)


ROWS = [(i, t) for i, t in enumerate(
    ["the cat sat", "The dog SAT on the mat", "", None, "éa éa \U0001f600", "the the the cat",
     "unseen words here", "a b\tc\nd", "the cat sat", "zz the"] * 2)]


@pytest.mark.parametrize("sizes", [{}, {"shard_size": 40, "head_size": 3}])
def test_scores_match_the_reference(spark, docs, sizes):
    df = docs(ROWS).selectExpr("*", "1 AS key", "2 AS n", "3 AS score")
    rows = M.evaluate(df, depth=2, **sizes).collect()
    train = [t for k, t in ROWS if not fold(k)]
    ref, text = Reference(train, 2), dict(ROWS)
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        b, n, known, total = base(train, text[r.doc_id])
        assert r.held_out == fold(r.doc_id) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(b, rel=1e-9)
        assert r.score == pytest.approx(ref.score(text[r.doc_id]), rel=1e-6)


def test_edges(spark, docs):
    df = docs([(None, "x y"), (1, "x y"), (1, "x y"), (2, "w " * 30_000)])
    rows = M.evaluate(df, depth=2).collect()
    assert len(rows) == 4 and not [r for r in rows if r.doc_id is None][0].held_out
    assert M.evaluate(df.limit(0), depth=2).count() == 0
    held = next(k for k in range(100) if fold(k))
    alone = M.evaluate(docs([(held, "ab")]), depth=2).collect()[0]
    assert alone.base_score is None and alone.n_known == 0
    assert alone.score == pytest.approx(-24 * math.log10(2))


def test_base_of_a_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    c = collections.Counter(w for k, t in text.items() if not fold(k) for w in [*M.tokens(t), None])
    n, v = sum(c.values()), len(c)
    for r in M.evaluate(df).collect():
        ws = [*M.tokens(text[r.doc_id]), None]
        assert r.n_known == sum(c[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(
            sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)


def test_held_out_text_is_compressed(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [r for r in M.evaluate(df).collect() if r.held_out]
    assert np.mean([r.bits_per_byte for r in rows]) < 2.6


def test_grams_stay_off_the_driver_in_bounded_shards(spark, docs, monkeypatch):
    rng = np.random.default_rng(3)  # one pair of bytes before most grams
    rows = [(k, " ".join(chr(97 + a) + "qq" + chr(97 + b) for a, b in rng.integers(0, 26, (40, 2))))
            for k in range(20)]
    want = {r.doc_id: r.score for r in M.evaluate(docs(rows), depth=3).collect()}
    met, arrays = [], M._arrays
    monkeypatch.setattr(M, "_arrays", lambda df: met.append(df.columns) or arrays(df))
    grams = M.cut(M.count(docs(rows).selectExpr("text", "false AS held_out"), 3), "test-grams") \
        .filter(f"kind = {M.GRAM}")
    bounds = M.shard_bounds(grams, 60)
    sizes = [r["count"] for r in M.score_grams(grams, 3, bounds).groupBy("shard").count().collect()]
    assert len(sizes) == len(bounds) + 1 and max(sizes) <= 60 < sum(sizes)
    assert max(r["count"] for r in grams.groupBy(F.expr("key >> 8 & 65535")).count().collect()) > 60
    got = {r.doc_id: r.score for r in M.evaluate(docs(rows), depth=3, shard_size=60).collect()}
    assert got == pytest.approx(want, rel=1e-9)
    assert ["key", "score"] not in met
