import pytest
from conftest import SF_SMALL
from llm_fixtures import docs  # noqa: F401
from pyspark.sql import functions as F
from sluice.llm import mixing as M


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight, the excess over the cap shared out again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) \
        + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 20, None: 5}, {"a": 0, "b": 7}, {"z": 3}, {None: 0},
    {"b": 1, "B": 1, "é": 900, "\U0001f600": 100, "￮": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def test_mix_reaches_its_targets_and_reruns_agree(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = df.withColumn("source", F.when(F.col("doc_id") % 40 == 0, None)
                       .when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    out = M.mix(df)
    rows = out.collect()
    text = {r.doc_id: (r.text, r.source) for r in df.collect()}
    by = {}
    for r in rows:
        assert r["size"] == len(text[r.doc_id][0].encode().split())
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
        by.setdefault(text[r.doc_id][1], []).append(r)
    sizes = {s: sum(r["size"] for r in v) for s, v in by.items()}
    want = targets(sizes)
    for s, v in by.items():
        assert v[0].source_size == sizes[s] and v[0].target == pytest.approx(want[s])
        # whole documents only: half of one may be missing or too much
        spare = max(r["size"] for r in v)
        assert abs(sum(r.taken for r in v) - want[s]) <= max(1, spare / 2)
        rate = want[s] / sizes[s]
        # whole copies are certain, the rest is sampled
        assert all(int(rate) <= r.copies <= int(rate) + 1 or r["size"] == 0 for r in v)
    again = M.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_weights_raise_inclusion(spark, docs):
    df = docs([(i, "one two three four", "en", "s" if i % 2 else "t") for i in range(4000)])
    df = df.withColumn("w", F.when(F.col("doc_id") % 4 < 2, 3.0).otherwise(1.0))
    rows = M.mix(df, weights=(1, 3), weight_col="w").collect()
    low = [r for r in rows if r.target == min(x.target for x in rows)]
    heavy = sum(r.copies for r in low if r.doc_id % 4 < 2)
    light = sum(r.copies for r in low if r.doc_id % 4 >= 2)
    assert heavy / light == pytest.approx(3, rel=0.25)


def test_edges(spark, docs):
    df = docs([(1, None, "en", "a"), (2, "", "en", "a"), (3, "x " * 20_000, "en", None),
               (None, "y z", "en", "a"), (4, "y z", "en", "a"), (4, "y z", "en", "a")])
    df = df.selectExpr("*", "1 AS size", "2 AS target", "3 AS copies", "4 AS tie", "5 AS key",
                       "6 AS of")
    rows = M.mix(df).collect()
    assert len(rows) == 6 and all(r.taken <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows} == {0, 2, 20_000}
    assert M.mix(df.limit(0)).count() == 0
    out = M.mixed(df)
    assert out.columns[:len(df.columns)] == df.columns and out.columns[-1] == "_copies"
    only_empty = docs([(1, "", "en", "a"), (2, None, "en", "b")])
    assert [(r.taken, r.target) for r in M.mix(only_empty).collect()] == [(0, 0.0)] * 2


def plain_mix(rows, weights=(1, 2, 3), cap=3):
    """Copies by key from rows ``key, source, size, tie, u``: certain whole copies, then the rest
    in Pareto order while it fits, then the nearest document."""
    by, out = {}, {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    want = targets({s: sum(r["size"] for r in v) for s, v in by.items()}, weights, cap)
    for s, own in by.items():
        total = sum(r["size"] for r in own)
        expected = min(want[s] / total if total else 0.0, float(cap))
        whole = int(expected + 1e-9)
        p = max(expected - whole, 0.0)

        def rank(r, p=p):
            u = r["u"]
            return u * (1 - p) / (u * (1 - p) + (1 - u) * p) if p > 0 else 1 + u

        order = sorted(own, key=lambda r: (rank(r), r["tie"], r["size"]))
        chosen = set()

        def gap():
            return want[s] - sum(r["size"] * (whole + (r["key"] in chosen)) for r in own)

        for _ in range(M.ROUNDS):
            left, run = gap(), 0
            for r in [r for r in order if r["key"] not in chosen and 0 < r["size"] <= left
                      and whole < cap]:
                run += r["size"]
                if run <= left:
                    chosen.add(r["key"])
        left = gap()
        near = [(abs(r["size"] - left), rank(r), r["key"]) for r in own
                if r["key"] not in chosen and whole < cap and abs(r["size"] - left) < left]
        if near:
            chosen.add(min(near)[2])
        out |= {r["key"]: whole + (r["key"] in chosen) for r in own}
    return out


@pytest.mark.parametrize("weights", [(1, 2, 3), (1, 40, 1)])
def test_ranks_and_filling_against_a_plain_version(spark, weights):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = df.withColumn("source", F.when(F.col("doc_id") % 40 == 0, None)
                       .when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    seed = 17
    tie = F.xxhash64(F.lit(seed), "doc_id", "text")
    u = (F.shiftrightunsigned(F.xxhash64(tie, F.lit(seed)), 11) + 0.5) / F.lit(float(1 << 53))
    rows = [r.asDict() for r in df.select(
        F.col("doc_id").alias("key"), "source", M.word_count(F.col("text")).alias("size"),
        tie.alias("tie"), u.alias("u")).collect()]
    got = {r.doc_id: r.copies for r in M.mix(df, weights=weights).collect()}
    assert got == plain_mix(rows, weights)


@pytest.mark.parametrize("p", [1e-4, 0.01, 0.5, 0.99, 1 - 1e-4])
def test_buckets_are_even_and_follow_the_ranks(spark, p):
    u = (F.col("id") + 0.5) / 200_000
    rows = spark.range(200_000).select(
        M._ranked(u, F.lit(p)).alias("rank"), M._bucket(u, F.lit(p), F.lit(p)).alias("bucket"),
        M._bucket(u, F.lit(p), F.lit(0.3)).alias("other"))
    assert rows.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 0.001 * 200_000
    got = [(r["bucket"], r["other"]) for r in rows.orderBy("rank").collect()]
    assert got == sorted(got) and [g[1] for g in got] == sorted(g[1] for g in got)
