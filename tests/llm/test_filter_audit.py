import itertools
import math
import random

import pytest
from llm_fixtures import docs  # noqa: F401
from sluice.llm.filter_audit import LETTERS, audit, interactions, paths

ORDERS = ["".join(o) for o in itertools.permutations(LETTERS)]


def plain(rows, labels):
    """Every order applied to the rows, step by step."""
    def fails(text, key):
        ws = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        lower = any(k is not None and key is not None and k < key and (t or "") == text
                    for k, t, *_ in rows)
        return {f for f, bad in zip(LETTERS, (
            len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text), lower)) if bad}

    seen = [(source or "", fails(text or "", key),
             any(k == key and q == 1 for k, q, _ in labels if k is not None),
             any(k == key and t == 1 for k, _, t in labels if k is not None))
            for key, text, source in rows]
    out = {}
    for part in {p for p, *_ in seen}:
        own = [s[1:] for s in seen if s[0] == part]
        total = dict.fromkeys(LETTERS, 0)
        for order in ORDERS:
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[0] for d in own) - len(gone),
                    sum(d[0] == {f} for d in own), sum(d[1] for d in gone),
                    sum(d[2] for d in gone)]
        for order in ORDERS:
            for step, f in enumerate(order, 1):
                out[part, order, step].append(total[f])
    return out


def test_paths_count_orders():
    forward, backward = paths(4)
    for s in range(16):
        n = bin(s).count("1")
        assert forward[s] == math.factorial(n) and backward[s] == math.factorial(4 - n)
    # every order uses one edge of each length
    assert sum(forward[s] * backward[s | 1 << i] for s in range(16) for i in range(4)
               if not s >> i & 1) == 24 * 4


@pytest.fixture(scope="module")
def table():
    rng = random.Random(7)
    texts = [None, "", "A b", "x | y", " ".join(f"w{i}" for i in range(210)),
             "W " * 250, " ".join(f"w{i}" for i in range(220)) + " $" + "Q" * 40,
             "\t".join(f"é{i}" for i in range(199)), "a\x0bb\x0c c\r\nd" * 80]
    rows = [(i if rng.random() > .05 else None, rng.choice(texts),
             rng.choice(["a", "b", None, ""])) for i in range(160)]
    rows += [rows[3], (5, "A b", "b"), (5, "A b", "b"), (6, "A b", "a")]
    labels = [(rng.randrange(170), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
              for _ in range(120)] + [(None, 1, 1)]
    return rows, labels


def frames(spark, docs, rows, labels):  # noqa: F811
    d = docs([(k, t, None, s) for k, t, s in rows])
    clash = d.selectExpr("*", "'x' AS part", "1 AS failed", "2 AS good", "3 AS kept")
    return clash, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_every_order_and_step_against_brute_force(spark, docs, table):  # noqa: F811
    rows, labels = table
    got = {(r.part, r.filter_order, r.step): [
        r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in audit(*frames(spark, docs, rows, labels)).collect()}
    assert got == plain(rows, labels)


def test_no_documents_and_no_labels(spark, docs):  # noqa: F811
    d, lab = frames(spark, docs, [(1, "A", "s")], [])
    assert audit(d.limit(0), lab).count() == 0
    assert audit(d, lab).count() == 600


def test_interactions_of_any_number_of_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 2, 0, 0), ("p", 3, 4, 1, 1)],
                                   "part string, failed int, docs long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
           for r in interactions(counts, "XY").collect()}
    assert got == {("XY", 1): (5, 6, 0, 2, 8), ("XY", 2): (5, 0, 4, 0, 4),
                   ("YX", 1): (7, 4, 0, 0, 4), ("YX", 2): (5, 2, 4, 2, 8)}
