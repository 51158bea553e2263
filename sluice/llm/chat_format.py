"""Chat formatting with a grammar round trip.

Every turn is rendered as ::

    ### Assistant:
    <text>
    </turn>

and a conversation is its turns one after the other. Headers and the end mark are control
strings; in a text each is written with one more backslash in front than it has, and the parser
takes one off, so a text may hold control strings, escaped ones included. Rendering starts with
the text as it is: the deterministic parser reads it back, and where the recovered turns differ
from the source, the control strings of the text are escaped and the turn is read again, until
both are identical.

Control strings hold no line break and a text has one on either side, so none can form across a
text's ends: turns can be settled one by one, before conversations are put together.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, quoted, slices

KNOWN = {"system": "System", "user": "User", "assistant": "Assistant"}
LEARNED = "assistant"
END = "</turn>"
HEADER = r"### (?:System|User|Assistant|Role=[\w.~%-]*):"
CONTROL = re.compile(rf"(\\*)({HEADER}|{END})", re.ASCII)
PART_CHARS = 1 << 20
PARTS = ("conv {key}, part long, single boolean, formatted string, "
         "spans array<struct<start: long, stop: long>>")


class GrammarError(ValueError):
    """A text is not a sequence of rendered turns."""


def header(role: str) -> str:
    """The first line of a turn; any role has one that no other role has."""
    return f"### {KNOWN.get(role) or 'Role=' + quote(role, safe='')}:"


def role_of(line: str) -> str:
    label = line[4:-1]
    if label.startswith("Role="):
        return unquote(label[5:])
    return label.lower()


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def render(role: str, body: str) -> str:
    return f"{header(role)}\n{body}\n{END}\n"


def parse(rendered: str) -> list[tuple[str, str]]:
    """Turns ``(role, text)`` of a rendered conversation. The grammar has one reading of any
    string: a header line, all up to the first bare control string, which is the end mark on a
    line of its own, and the next turn. Anything else is a :class:`GrammarError`."""
    turns, at = [], 0
    while at < len(rendered):
        head = CONTROL.match(rendered, at)
        if not head or head[1] or head[2] == END or not rendered.startswith("\n", head.end()):
            raise GrammarError(f"no header at {at}")
        start = head.end() + 1
        stop = next((m for m in CONTROL.finditer(rendered, start) if not m[1]), None)
        if stop is None or stop[2] != END or not rendered.startswith("\n", stop.end()):
            raise GrammarError(f"turn at {at} has no end")
        if stop.start() == start or rendered[stop.start() - 1] != "\n":
            raise GrammarError(f"end mark at {stop.start()} is not on a line of its own")
        turns.append((role_of(head[2]), unescape(rendered[start:stop.start() - 1])))
        at = stop.end() + 1
    return turns


def recovered(rendered: str) -> list[tuple[str, str]] | None:
    try:
        return parse(rendered)
    except GrammarError:
        return None


def settle(role: str, text: str) -> str:
    """The text as it stands in the rendered turn: escaped only if the turn would be read back
    otherwise."""
    body = text
    for change in (escape, None):
        if recovered(render(role, body)) == [(role, text)]:
            return body
        if change:
            body = change(body)
    raise GrammarError("a turn does not survive the round trip")


def _settled(batches):
    for batch in slices(batches, 3):
        roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        bodies = [settle(r, t) for r, t in zip(roles, texts)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(bodies, pa.string())], ["conv", "turn", "role", "body"])


class _Parts:
    """Rows of parts, gathered into batches of bounded size."""

    def __init__(self, key_type):
        self.schema = pa.schema([
            ("conv", key_type), ("part", pa.int64()), ("single", pa.bool_()),
            ("formatted", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
        self.rows, self.size = [], 0

    def add(self, conv, part, single, pieces, spans):
        text = "".join(pieces)
        self.rows.append((conv, part, single, text,
                          [{"start": a, "stop": b} for a, b in spans]))
        self.size += len(text) + 64

    def batch(self):
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)],
            schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _joined(batches, part_chars: int):
    """Consecutive rows of a conversation become parts of whole turns, a new one once a part
    has ``part_chars`` code points: nothing but the open part is held."""
    parts, open_ = None, False
    now, number, pieces, spans, size = None, 0, [], [], 0
    for batch in slices(batches, 3):
        parts = parts or _Parts(batch.column(0).type)
        for conv, role, body in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if open_ and conv != now:
                parts.add(now, number, number == 0, pieces, spans)
                number, pieces, spans, size = 0, [], [], 0
            elif open_ and size >= part_chars:
                parts.add(now, number, False, pieces, spans)
                number, pieces, spans, size = number + 1, [], [], 0
            now, open_ = conv, True
            piece = render(role, body)
            if role == LEARNED:
                start = size + len(header(role)) + 1
                spans.append((start, start + len(body)))
            pieces.append(piece)
            size += len(piece)
            if parts.size >= 4 << 20:
                yield parts.batch()
    if open_:
        parts.add(now, number, number == 0, pieces, spans)
    if parts and parts.rows:
        yield parts.batch()


def format_chats(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 part_chars: int = PART_CHARS) -> DataFrame:
    """``conv, part, single, formatted, spans``: every conversation rendered, with the spans of
    code points under the loss mask (the assistant's texts as rendered).

    A conversation is one row with ``single``; one of over ``part_chars`` code points is
    several, each of whole turns, in the order of ``part``. Rows go by turn, equal turns by role
    and text, null turns first; null texts and roles are empty; repeated rows are turns each;
    rows without a conversation id are one conversation of null id; other columns are not read;
    without rows the result is empty.
    """
    src = chats.select(
        quoted(conv_col).alias("conv"), quoted(turn_col).alias("turn"),
        *(F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n)
          for c, n in ((role_col, "role"), (text_col, "body"))))
    kinds = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    bodies = src.mapInArrow(
        _settled, f"conv {kinds['conv']}, turn {kinds['turn']}, role string, body string")
    return bodies.repartition("conv").sortWithinPartitions(
        "conv", "turn", "role", "body").mapInArrow(
            lambda batches: _joined(batches, part_chars), PARTS.format(key=kinds["conv"]))


def _read_back(batches):
    """Digests of what the parser finds in the formatted conversations; a conversation's parts
    come one after the other."""
    now, open_, state = None, False, None
    rows, kind = [], None

    def close():
        n, turns, chars, learned, total = state
        rows.append((now, n, turns.hexdigest(), chars, learned.hexdigest(), total))

    def out():
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in slices(batches, 2):
        kind = batch.column(0).type
        for conv, text, spans in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if open_ and conv != now:
                close()
                open_ = False
            if not open_:
                now, open_ = conv, True
                state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns = parse(text)
            state[0] += len(turns)
            state[1].update("".join(f"{r}\n{t}\n" for r, t in turns).encode())
            under = "".join(unescape(text[s["start"]:s["stop"]]) for s in spans)
            state[2] += len(under)
            state[3].update(under.encode())
            state[4] += len(text)
        if len(rows) >= 10_000:
            yield out()
            rows.clear()
    if open_:
        close()
    if rows:
        yield out()


def read_back(parts: DataFrame) -> DataFrame:
    """``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of formatted
    conversations, read from their rendered text alone.

    Conversations of one row are read where they lie. The parts of longer ones are brought
    together and pass through in order: a SHA-256 over all turns has no parallel form, so it is
    one stream per conversation, of which one batch is held.
    """
    kind = parts.schema["conv"].dataType.simpleString()
    schema = (f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")
    cols = ["conv", "part", "formatted", "spans"]
    long = parts.filter("NOT single").select(*cols)
    long = long.repartition("conv").sortWithinPartitions("conv", "part")
    whole = parts.filter("single").select(*cols)
    return whole.mapInArrow(_read_back, schema).unionByName(long.mapInArrow(_read_back, schema))


def check_chats(chats: DataFrame, conv_col: str = "conv_id", **options) -> DataFrame:
    """Formats the conversations into the shared folder and reads them back; the columns of
    :func:`read_back` with the id under its own name. Same rules for nulls, ties and repeated
    rows as :func:`format_chats`."""
    parts = cut(format_chats(chats, conv_col, **options), "chat-format")
    return read_back(parts).withColumnRenamed("conv", conv_col)
