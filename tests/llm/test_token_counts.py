import random

import pytest
from conftest import SF_SMOKE
from llm_fixtures import docs  # noqa: F401
from sluice.llm.registry import vocabulary
from sluice.llm.token_counts import Counter, byte_symbols, token_counts

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


def want(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_match_the_library(library):
    rng = random.Random(1)
    alphabet = [chr(i) for i in range(0x250)] + [
        " ", "　", "​", " ", "١", "Ⅻ", "²", "é", "日",
        "\U0001f600", "<|endoftext|>", "'s", "'ll", " ", "  ", "\n", "aaa", "\x85", "\x1c", "\x1f"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a" * 5000, " " * 3000, "ab" * 4000, "", "<|endoftext|><|endoftext|> x<|endoftext|>"]
    assert Counter(vocabulary()).counts(texts) == want(library, texts)


def test_long_unbroken_runs_match_the_library(library):
    import time

    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet, n in (
        (letters, 5_000), ("ab", 4_000), ("acgt", 30_000), (letters.upper() + letters, 20_000),
        ("é日a", 6_000), (letters, 1_000_000))]
    texts += ["a" * 1025, "a" * 100_001, " " * 5000 + "x", "ab" * 50_000, "=" * 4097]
    counter = Counter(vocabulary())
    started = time.process_time()
    got = counter.counts(texts)
    assert time.process_time() - started < 40
    assert got == want(library, texts)


def test_the_index_of_positions_gives_the_counts_of_the_rounds():
    rng = random.Random(9)
    merger = Counter(vocabulary()).merger
    pieces = ["".join(rng.choice("etaoin shr"[:rng.randrange(1, 10)]) for _ in range(
        rng.randrange(1, 60))).encode() for _ in range(300)]
    assert [merger.long_count(p) for p in pieces] == merger.counts(pieces).tolist()


def test_every_byte_has_its_own_symbol():
    assert len(set(byte_symbols())) == 256


def test_query_rows(spark, docs, library):
    texts = ["", None, "hello world", "x" * 40_000, "hello world"]
    df = docs([(i if i != 3 else None, t) for i, t in enumerate(texts)])
    df = df.selectExpr("*", "'clash' AS n_tokens", "1 AS key")
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in
                 token_counts(df, vocabulary()).collect())
    n = want(library, ["hello world", "x" * 40_000])
    assert got == sorted([(0, 0, False), (0, 0, False), (11, n[0], False), (11, n[0], False),
                          (40_000, n[1], n[1] > 1024)])
    assert token_counts(df.limit(0), vocabulary()).count() == 0


def test_whole_table(spark, library):
    df = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, vocabulary()).collect()}
    rows = df.collect()
    assert [got[r.doc_id] for r in rows] == want(library, [r.text for r in rows])
