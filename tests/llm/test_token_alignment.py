import hashlib
import random
from collections import Counter

import pytest
from conftest import SF_SMOKE
from llm_fixtures import docs  # noqa: F401
from sluice.llm import token_alignment
from sluice.llm.registry import vocabulary
from sluice.llm.token_alignment import Aligner, alignment, group_bounds

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A, B = vocabulary(), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Counts, listing digest and links of one text, from the libraries' tokens."""
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    tables = Aligner(A, B)

    def one(text):
        if not text:
            return (0, 0, 0, 0), "", {}
        raw = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelled = [[side.table[i] for i in x] for side, x in zip((tables.a, tables.b), ids)]
        if any(b"".join(x) != raw for x in spelled):
            return (0, 0, 0, 0), "", {}
        ends = []
        for x in spelled:
            at, own = 0, set()
            for piece in x:
                at += len(piece)
                own.add(at)
            ends.append(own)
        common, groups = ends[0] & ends[1], []
        for x, own in zip(spelled, ids):
            at, cur, side = 0, [], []
            for piece, i in zip(x, own):
                at += len(piece)
                cur.append(i)
                if at in common:
                    side.append(cur)
                    cur = []
            groups.append(side)
        links = Counter((p, q) for x, y in zip(*groups) for p in x for q in y)
        listing = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y))
                           for x, y in zip(*groups))
        return ((len(ids[0]), len(ids[1]), len(groups[0]), sum(links.values())),
                hashlib.sha256(listing.encode()).hexdigest(), links)

    return one


def samples(n=300):
    rng = random.Random(3)
    abc = [chr(i) for i in range(32, 0x250)] + [
        *"日本語あ▁\U0001f600\n\t  　\x85\x1c᠎", "<|endoftext|>", "<s>", "<0x41>", "the ", "  ",
        "aaaa", "</s>"]
    return [None, "", " ", "  ", "a ", "a  ", " a", "▁", "x▁y z", "x" * 5000 + " a " + "1" * 9000,
            " " * 4000, "ab" * 3000, "日" * 3000] + [
        "".join(rng.choice(abc) for _ in range(rng.randrange(150))) for _ in range(n)]


@pytest.mark.parametrize("limits", [(1 << 26, 1 << 20, 1 << 12), (50, 1000, 3)])
def test_groups_and_links_equal_those_of_the_libraries(plain, monkeypatch, limits):
    for name, value in zip(("KEPT", "CHUNK", "WIDE"), limits):
        monkeypatch.setattr(token_alignment, name, value)
    aligner, texts = Aligner(A, B), samples()
    assert aligner.cuts
    for part in (texts[:200], texts[100:]):  # some units are met again
        counts, digests, (doc, pair, times) = aligner.align(part)
        got = [{} for _ in part]
        for d, p, n in zip(doc.tolist(), pair.tolist(), times.tolist()):
            got[d][divmod(p, aligner.size_b)] = n
        for i, text in enumerate(part):
            assert (tuple(counts[i].tolist()), digests[i], got[i]) == plain(text), repr(text)


def test_vocabularies_that_join_over_spaces_take_whole_texts(plain):
    aligner, texts = Aligner(A, B), samples(40)
    aligner.cuts = False
    counts, digests, _ = aligner.align(texts)
    assert [(tuple(c.tolist()), d) for c, d in zip(counts, digests)] == [
        plain(t)[:2] for t in texts]


def test_the_faster_library_gives_the_same_tokens():
    a = Aligner(A, B).a
    texts = [" " + (t or "") for t in samples(2000)]
    want = [e.ids for e in a.library.encode_batch(texts, add_special_tokens=False)]
    assert a.quick is not None
    assert [a.quick.encode_ordinary(t) for t in texts] == want


def test_a_long_unbroken_text_and_long_blanks_end_soon(plain):
    rng = random.Random(2)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    blanks = " " * 200_000 + "x" + "\n" * 100_000
    for text in (letters, blanks):
        counts, digests, _ = Aligner(A, B).align([text])
        assert (tuple(counts[0].tolist()), digests[0]) == plain(text)[:2]


def test_common_ends():
    import numpy as np

    a, b = group_bounds(np.array([2, 3, 7, 9]), np.array([1, 3, 9]))
    assert a.tolist() == [2, 4] and b.tolist() == [2, 3]


def expected(plain, rows):
    found = [plain(t) for _, t in rows]
    held = Counter(p for _, _, links in found for p in links)
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((k, *counts, sum(n for p, n in links.items() if held[p] == best[p[0]]),
                    sum(n * held[p] for p, n in links.items()), digest)
                   for (k, _), (counts, digest, links) in zip(rows, found)), key=repr)


@pytest.mark.parametrize("head", [1 << 18, 20, 0])
def test_corpus_counts(spark, docs, plain, head):  # noqa: F811
    texts = samples(60)
    rows = [(i if i % 13 else None, t) for i, t in enumerate(texts)] + [(5, texts[40])] * 3
    df = docs(rows).selectExpr("*", "'clash' AS pair", "1 AS n", "2 AS key", "3 AS row")
    got = alignment(df, A, B, head=head).collect()
    assert sorted(map(tuple, got), key=repr) == expected(plain, rows)


def test_empty_table(spark, docs):  # noqa: F811
    assert alignment(docs([(1, "a")]).limit(0), A, B).count() == 0


def test_whole_table(spark, plain):
    df = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = alignment(df, A, B, head=500).collect()
    assert sorted(map(tuple, got), key=repr) == expected(plain, rows)
