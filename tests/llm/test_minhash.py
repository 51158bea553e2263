import collections
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from llm_fixtures import docs  # noqa: F401
from sluice.llm import minhash as M
from sluice.llm.graph import components


def sets_of(rows):
    out = []
    for _, text in rows:
        ws = (text or "").encode().lower().split()
        out.append(frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5
                   else frozenset([tuple(ws)] if ws else []))
    return out


def brute_force(rows):
    """Smallest id of each row's component, by comparing all pairs that share a shingle."""
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for pair in {(a, b) for v in holders.values() for a in v for b in v if a < b}:
        a, b = (sets[i] for i in pair)
        if 100 * len(a & b) >= 75 * len(a | b):
            parent[find(pair[0])] = find(pair[1])
    ids = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        ids[find(i)].append(key)
    return [min((k for k in ids[find(i)] if k is not None), default=None) if sets[i]
            else rows[i][0] for i in range(len(rows))]


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 + str(rng.random()) if rng.random() < share else w
            for w in words]


def test_components_of_a_hub_a_chain_and_loops(spark):
    edges = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(200)} | {i: 300 for i in range(300, 341)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_estimates_similarity():
    rng, sampler = np.random.default_rng(1), M.Sampler()
    for j in (0.75, 0.9, 1.0):
        got = []
        for _ in range(200):
            same = rng.integers(0, 1 << 63, int(400 * j), dtype=np.uint64)
            own = rng.integers(0, 1 << 63, (2, (400 - len(same)) // 2), dtype=np.uint64)
            a, b = (sampler.sketch(sampler.samples(np.unique(np.r_[same, x]))) for x in own)
            flips = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
            assert flips <= M.flips_allowed(0.75)
            got.append(M.estimate(flips))
        assert abs(np.mean(got) - j) < 0.02


def test_groups_of_edited_copies_match_brute_force(spark, docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, key = [], 0
    passage = [word() for _ in range(60)]
    for size, share in ((40, 0.02), (60, 0.05), (30, 0.08)):
        origin = [word() for _ in range(150)]
        for _ in range(size):
            rows.append((key, " ".join(edited(rng, origin, share))))
            key += 1
    for _ in range(80):  # documents that share a passage only
        rows.append((key, " ".join(passage + [word() for _ in range(rng.randrange(10, 80))])))
        key += 1
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    want = brute_force(rows)
    assert len(set(want)) < len(rows)
    got = {r.doc_id: r.component_id for r in M.near_dups(docs(rows)).collect()}
    assert [got[i] for i, _ in rows] == want


def test_edges(spark, docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a b c d e f g"), (2, "A B C D E F G"), (3, None), (4, ""), (5, "a b"), (6, "A  b"),
            (7, "b a"), (None, "a b c d e f g"), (2, "A B C D E F G"), (8, long), (9, long + " x"),
            (None, "only null"), (10, " \t\n")]
    df = docs(rows).selectExpr("*", "1 AS mark", "2 AS cid", "3 AS key", "4 AS of")
    got = M.near_dups(df).collect()
    assert len(got) == len(rows)
    want = collections.Counter(zip((r[0] for r in rows), map(len, sets_of(rows)), brute_force(rows)))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    kept = M.dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        [1, 3, 4, 5, 7, 8, None, 10], key=str)
    assert M.near_dups(df.limit(0)).count() == 0 and M.dedup(df.limit(0)).count() == 0


def test_small_table_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: r.component_id for r in M.near_dups(df).collect()}
    assert [got[k] for k, _ in rows] == brute_force(rows)


@pytest.mark.parametrize("percent", [75])
def test_crowded_bucket_pairs_lose_no_link(spark, percent):
    """``across`` makes every pair of different components at the threshold."""
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 62, 80, dtype=np.uint64)
    sets = [np.unique(base)]
    for _ in range(60):
        keep = base[rng.random(80) < rng.choice([0.7, 0.85, 0.95])]
        pool = rng.integers(1, 40, 30, dtype=np.uint64)
        sets.append(np.unique(np.r_[keep, pool[:rng.integers(0, 30)]]))
    df = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)],
                               "cid long, shingles binary")
    group = spark.createDataFrame([(0, i, i) for i in range(len(sets))],
                                  "hub long, cid long, root long")
    got = {tuple(sorted(r)) for r in M.across(group, df, percent).collect()}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = len(np.intersect1d(a, b))
            if j and 100 * same >= percent * (len(a) + len(b) - same):
                assert (j, i) in got


@pytest.mark.parametrize("chunk", [2, 1 << 12])
def test_shingles_of_several_components_are_kept(spark, chunk):
    rng = np.random.default_rng(8)
    rows = [(h, 100 * h + i, 100 * h + (i if i % 4 == 0 else 1), 50, 9,
             rng.permutation(60)[:rng.integers(0, 9)].tolist())
            for h in range(3) for i in range(40)] + [(7, 700, 700, 5, 5, [1]), (7, 701, 700, 5, 5, [1])]
    known = spark.createDataFrame(
        rows, "hub long, cid long, root long, n long, o long, rest array<long>")
    holders = {}
    for hub, cid, root, _, _, rest in rows:
        for t in rest:
            holders.setdefault((hub, t), set()).add((cid, root))
    want = {(hub, t, cid) for (hub, t), own in holders.items() if len({r for _, r in own}) > 1
            for cid, _ in own}
    got = M._foreign_tokens(known, chunk).collect()
    assert want <= {(r.hub, r.token, r.cid) for r in got}
    assert len(got) == len({(r.hub, r.token, r.cid) for r in got})
    assert not [r for r in got if r.hub == 7]
    # nothing of the largest component beyond what others have
    assert all((r.hub, r.token, r.cid) in want for r in got if r.root % 100 == 1)
    assert all(r.r == len(rows[40 * r.hub + r.cid % 100][5]) for r in got)


def test_crowd_meets_the_head_of_its_hub(spark):
    """A class of many crowds with linked hubs meets one of them, not each."""
    hubs, members = range(10), range(100, 160)
    group = spark.createDataFrame([(h, m, m) for h in hubs for m in members] + [(70, 5, 5)],
                                  "hub long, cid long, root long")
    links = spark.createDataFrame([(0, h) for h in hubs if h], "a long, b long")
    company = spark.createDataFrame([(h, 90 - h) for h in hubs] + [(70, 3)],
                                    "cid long, company long")
    roots = spark.createDataFrame([(h, 0) for h in hubs], "cid long, root long")
    got = M.headed(group, links, company, roots).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == {(0, m, m) for m in members} | {
        (0, 0, 0), (70, 5, 5), (70, 70, 70)}


def test_largest_component_meets_no_chunks_of_a_crowd(spark):
    """Its members with no shingle of another component make no row, however many there are of
    either."""
    rows = [(1, i, 0, 50, 9, [i, 7]) for i in range(400)] + [
        (1, 1000 + i, 1000 + i, 50, 9, [5000 + 100 * i + k for k in range(50)]) for i in range(300)]
    rows.append((1, 2000, 2000, 50, 9, [3]))
    known = spark.createDataFrame(
        rows, "hub long, cid long, root long, n long, o long, rest array<long>")
    got = M._foreign_tokens(known)
    assert "array_intersect" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = got.collect()
    assert {(r.cid, r.token) for r in rows if r.root == 0} == {(3, 3)}
    assert len(rows) == 300 * 50 + 2


@pytest.mark.parametrize("words", [2, 1 << 20])
def test_edits_of_one_component_are_no_rows(spark, words):
    """Shingles that no other component of the crowd has are dropped before they become rows."""
    rows = [(1, i, i, 50, 9, [100 * i + 100 + k for k in range(40)] + [7]) for i in range(300)] + [
        (1, 1000 + i, 1000, 50, 9, [-i, 5, 9]) for i in range(50)] + [
        (2, i, i, 50, 9, [100 * i, -2]) for i in range(9)] + [(2, 70, 70, 50, 9, []), (3, 1, 1, 5, 4, [7])]
    known = spark.createDataFrame(
        rows, "hub long, cid long, root long, n long, o long, rest array<long>")
    holders = {}
    for hub, _, root, _, _, rest in rows:
        for t in rest:
            holders.setdefault((hub, t), set()).add(root)
    got = M._shared(known.repartition(5), words).collect()
    assert sorted(r[:5] for r in got) == sorted(r[:5] for r in rows)
    want = {(r[0], r[1]): [t for t in r[5] if len(holders[r[0], t]) > 1] for r in rows}
    assert all(set(want[r.hub, r.cid]) <= set(r.rest) for r in got)
    assert all(list(r.rest) == [t for t in full[5] if t in r.rest]
               for r in got for full in rows if full[:2] == (r.hub, r.cid))
    if words > 2:      # a few of 12,000 shingles may meet in a slot by chance
        needed = sum(map(len, want.values()))
        assert sum(len(r.rest) for r in got) <= needed + 20
        assert needed <= M._foreign_tokens(M._shared(known, words)).count() <= needed + 20
