import hashlib

import numpy as np
from conftest import SF_SMALL
from llm_fixtures import docs  # noqa: F401
from sluice.llm import imatch as M


def edited(rows):
    """Edited texts by order of (id, text), null ids first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        out.append((key, len(text), hashlib.sha256((text[:len(text) - q] + after[:q]).encode())
                    .hexdigest()))
    return out


def test_edges(spark, docs):
    rows = [(5, "alpha beta gamma delta"), (3, None), (9, ""), (None, "lone null id text"),
            (7, "x " * 20_000), (8, "\U0001f600é" * 9), (8, "a second text under one id"),
            (11, "alpha beta gamma delta"), (11, "alpha beta gamma delta")]
    df = docs(rows).selectExpr("*", "1 AS `at`", "2 AS mark", "3 AS range", "4 AS print", "5 AS own")
    got = M.fingerprints(df).collect()
    assert sorted((r.doc_id or -1, r.n_chars, r.edited_sha256) for r in got) == sorted(
        (k or -1, n, h) for k, n, h in edited(rows))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {r.fingerprint for r in got if r.n_chars == 22}
    assert len(same) == 1
    assert [r.near_next for r in got if r.doc_id == 11].count(1.0) >= 1
    assert M.fingerprints(df.limit(0)).count() == 0
    one = M.fingerprints(docs([(1, "abcdefgh")])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_successors_over_many_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 3)
    rows = [(i * i - 50, f"text {i} {'y' * (i % 7)}") for i in range(150)] + [(None, "n"), (0, "z")]
    got = M.fingerprints(docs(rows)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) \
        == sorted((k is not None, k or 0, n, h) for k, n, h in edited(rows))


def test_lexicon_is_the_band(spark, docs):
    df = docs([(i, " ".join(["all"] + ["mid"] * (i % 5 == 0) + [f"rare{i}"])) for i in range(100)])
    names = {w: spark.sql(f"SELECT xxhash64('{w}')").first()[0] for w in ("all", "mid", "rare1")}
    assert M.lexicon(df, low=0.05, high=0.5) == [names["mid"]]


def test_likeness_separates_edited_from_other_texts(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = M.fingerprints(df).collect()
    text = {r.doc_id: r.text for r in df.collect()}
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(edited(text.items()))
    assert np.mean([r.near_edited for r in rows]) > 0.4 > 0.1 > np.mean([r.near_next for r in rows])
    by = {}
    for r in rows:
        by.setdefault(text[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())
    assert len({next(iter(v)) for v in by.values()}) > 0.97 * len(by)


def _hash(*values):
    """Spark's xxhash64 of a string, longs or ints in turn, as a signed long."""
    import struct

    import xxhash
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<i" if v[0] == "int" else "<q", v[1])
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_signature(text, lex):
    """Hashes of the sorted distinct lexicon terms of each subset, subset by subset."""
    every = sorted({_hash(w) for w in text.lower().split()})
    kept = [t for t in every if t in lex] or every
    out = []
    for cells, n, draws in M.RATES:
        for draw in range(draws):
            cell = {t: _hash(("long", t), ("int", cells + draw)) % cells if cells > 1 else 0
                    for t in kept}
            for j in range(n):
                part = [t for t in kept if cell[t] == j]
                # below the full lexicon a term is hashed with its cell
                own = [("long", v) for t in part for v in ((t, j) if cells > 1 else (t,))]
                out.append(_hash(*own) & 0xFFFFFFFF if part else 0)
    return out


def plain_likeness(a, b):
    at, best = 0, 1.0
    for _, cells, draws in M.RATES:
        n = cells * draws
        pairs = [(x, y) for x, y in zip(a[at:at + n], b[at:at + n]) if x or y]
        if len(pairs) >= min(n, M.ENOUGH):
            best = sum(x == y for x, y in pairs) / len(pairs)
        at += n
    return best


def test_signatures_and_likeness_against_a_plain_version(spark, docs):
    import random
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(120)] + ["Ünder", "É", "x" * 50]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 20, 90]))) for _ in range(60)]
    texts += [texts[5], " \t\n ", "only rare words here", "ÜNDER  ünder É"]
    rows = list(enumerate(texts))
    df = docs(rows)
    lex = M.lexicon(df)
    df_of = {}
    for t in texts:
        for w in {_hash(w) for w in t.lower().split()}:
            df_of[w] = df_of.get(w, 0) + 1
    assert lex == sorted(w for w, n in df_of.items()
                         if n > 1 and M.LOW * len(texts) <= n <= M.HIGH * len(texts))
    got = {r.doc_id: r for r in M.fingerprints(df).collect()}
    own = [plain_signature(t, set(lex)) for t in texts]
    for i, text in rows:
        after = texts[(i + 1) % len(texts)]
        q = len(text) // 4
        other = plain_signature(text[:len(text) - q] + after[:q], set(lex))
        r = got[i]
        assert r.fingerprint == "".join(f"{h:08x}" for h in own[i])
        assert r.edited_fingerprint == "".join(f"{h:08x}" for h in other)
        assert (r.near_edited, r.near_next) == (
            plain_likeness(own[i], other), plain_likeness(own[i], own[(i + 1) % len(texts)]))
