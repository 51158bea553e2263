import hashlib
import random

import pytest
from sluice.llm.chat_format import (GrammarError, check_chats, escape, format_chats, header, parse,
                                    render, settle, unescape)

PIECES = ["### User:", "### Assistant:", "</turn>", "\\", "\n", "\\\\", "x", " ", "### ",
          "### Role=a%20:", "### Role=", "User:", "é", "</tu", "rn>", "#", "\U0001f600"]
ROLES = ["user", "assistant", "system", "", "Assistant", "a b:\n", "### User:", "é/%", "role=x"]
SCHEMA = "conv_id long, turn long, role string, text string"


def test_random_conversations_survive_the_round_trip():
    rng = random.Random(5)
    for _ in range(3000):
        turns = [(rng.choice(ROLES), "".join(rng.choice(PIECES) for _ in range(rng.randrange(9))))
                 for _ in range(rng.randrange(4))]
        assert parse("".join(render(r, settle(r, t)) for r, t in turns)) == turns


def test_only_conflicting_texts_are_escaped():
    assert settle("user", "plain \\ ### text") == "plain \\ ### text"
    assert settle("user", "a </turn>") == "a \\</turn>"
    assert unescape(escape("\\### User: </turn>")) == "\\### User: </turn>"
    assert len({header(r) for r in ROLES}) == len(ROLES)


@pytest.mark.parametrize("text", ["x", "### User:", "### User:\nx", "### User:\nx</turn>\n",
                                  "### User:\n</turn>\n", "### User:\nx\n### User:\n</turn>\n",
                                  "\\### User:\nx\n</turn>\n", "### User:\nx\n</turn>"])
def test_other_strings_are_no_conversations(text):
    with pytest.raises(GrammarError):
        parse(text)


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, role or "", text or "")
                      for c, t, role, text in rows if c == conv))
        said = "".join(f"{r}\n{t}\n" for *_, r, t in own)
        learned = "".join(t for *_, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(rng.choice([None, *range(20)]), rng.choice([None, *range(6)]),
            rng.choice([None, "assistant", *ROLES]),
            rng.choice([None, "", "".join(rng.choice(PIECES) for _ in range(12))]))
           for _ in range(400)]
    # a conversation of a third of the rows, with a very long text and equal rows
    out += [(99, i // 2, "assistant" if i % 3 else "user", "</turn>" * (i % 5)) for i in range(200)]
    return out + [(99, 500, "assistant", "é### User:" * 50_000), (99, 0, "user", ""),
                  (-7, 0, "user", "\\### Assistant: </turn> ok"),
                  (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@pytest.mark.parametrize("part_chars", [1 << 20, 300])
def test_what_is_read_back_equals_the_source(spark, rows, part_chars):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "'clash' AS conv", "1 AS part", "2 AS body")
    got = check_chats(df, part_chars=part_chars).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in got} == plain(rows)
    whole = {}
    for p in format_chats(df).collect():
        whole[p.conv] = whole.get(p.conv, 0) + len(p.formatted)
    assert {r.conv_id: r.formatted_chars for r in got} == whole


def test_parts_hold_whole_turns_in_order(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    parts = sorted((r.part, r.formatted, r.spans, r.single)
                   for r in format_chats(df, part_chars=300).collect() if r.conv == 99)
    assert len(parts) > 1 and not any(p[3] for p in parts)
    assert [p[0] for p in parts] == list(range(len(parts)))
    turns = [t for p in parts for t in parse(p[1])]
    spans = [unescape(p[1][s.start:s.stop]) for p in parts for s in p[2]]
    assert spans == [t for r, t in turns if r == "assistant"]
    whole, = [r for r in format_chats(df).collect() if r.conv == 3]
    assert whole.single and whole.part == 0


def test_no_rows(spark):
    assert check_chats(spark.createDataFrame([], SCHEMA)).count() == 0
