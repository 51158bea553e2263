"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters (normalised) may occur in a document with up to ``k = rate * n``
edits. Split into k + 1 pieces, one piece at least must then occur unchanged: an Aho-Corasick
automaton over all pieces finds those hits in one pass over a text, a q-gram count (which no
true match can fail) drops most chance hits, and Myers' bit-parallel distance verifies the rest
over the stretch of text that the hit allows.

Test items are taken in blocks of bounded size, so automata stay bounded; each block is matched
against all documents.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices

RATE = 0.1
BLOCK_CHARS = 1 << 20
GRAM = 3


def normalise(text: str | None) -> str:
    """Lower case, white space runs as one space."""
    return " ".join((text or "").lower().split())


def myers(peq: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Least edit distance of a pattern to any substring of ``text`` and where the first such
    substring ends. ``peq``: bit i of a character's mask is set where the pattern has it."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    vp, vn, score = full, 0, size
    best, end = size, 0
    get = peq.get
    for i, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | vn
        xh = (((eq & vp) + vp) ^ vp) | eq
        hp = vn | ~(xh | vp) & full
        hn = vp & xh
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
            if score < best:
                best, end = score, i
        hp = hp << 1 & full
        hn = hn << 1 & full
        vp = hn | ~(xv | hp) & full
        vn = hp & xv
    return best, end


def _slots(text: str) -> np.ndarray:
    """A slot from 0 to 4095 for each ``GRAM``-gram of characters."""
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(p) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    mixed = p[:n].copy()
    for i in range(1, GRAM):
        mixed = mixed * np.uint32(0x9E3779B1) + p[i:n + i]
    return mixed * np.uint32(0x85EBCA6B) >> np.uint32(20)


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple], rate: float):
        self.items, self.rate = items, rate
        self.texts = [normalise(t) for _, t in items]
        self.budget = [int(len(t) * rate) for t in self.texts]
        self.peq: list[dict[str, int]] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (text, k) in enumerate(zip(self.texts, self.budget)):
            masks: dict[str, int] = {}
            for i, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << i
            self.peq.append(masks)
            if not text:
                continue
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        # slots of the item's grams, and how many of them must be met: an edit spoils GRAM
        self.own = [_slots(t) for t in self.texts]
        self.need = [len(t) - GRAM + 1 - GRAM * k for t, k in zip(self.texts, self.budget)]
        self.machine = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.machine.add_word(piece, (len(piece), places))
        self.empty = not pieces
        if pieces:
            self.machine.make_automaton()

    def hits(self, text: str | None) -> list[tuple]:
        """``(item, distance, budget, end)`` of each item that occurs, ``end`` being where its
        best occurrence ends in the normalised text."""
        text = normalise(text)
        if self.empty or not text:
            return []
        spans: dict[int, list[tuple[int, int]]] = {}
        for last, (size, places) in self.machine.iter(text):
            for n, offset in places:
                k, begin = self.budget[n], last - size + 1 - offset
                spans.setdefault(n, []).append(
                    (max(0, begin - k), min(len(text), begin + len(self.texts[n]) + k)))
        found = []
        slots = _slots(text) if spans else None
        for n, stretches in sorted(spans.items()):
            best = self.best(n, text, slots, _joined(stretches))
            if best:
                found.append((self.items[n][0], best[0], self.budget[n], best[1]))
        return found

    def best(self, n: int, text: str, slots: np.ndarray, stretches) -> tuple[int, int] | None:
        """Least distance within budget over the stretches (the first of equals)."""
        size, k, own, need = len(self.texts[n]), self.budget[n], self.own[n], self.need[n]
        best = None
        for a, b in stretches:
            if need > 0:
                here = np.zeros(4096, bool)
                here[slots[a:max(a, b - GRAM + 1)]] = True
                if np.count_nonzero(here[own]) < need:
                    continue
            score, end = myers(self.peq[n], size, text[a:b])
            if score <= k and (best is None or score < best[0]):
                best = score, a + end
        return best


def _joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Overlapping stretches as one."""
    spans.sort()
    a, b = spans[0]
    for c, d in spans[1:]:
        if c > b:
            yield a, b
            a, b = c, d
        else:
            b = max(b, d)
    yield a, b


@functools.lru_cache(maxsize=1)
def _matcher(held) -> Matcher:
    return Matcher(*held.value)


def _blocks(items: DataFrame, id_col: str, text_col: str, rate: float, limit: int):
    """Broadcast blocks of items, each of ``limit`` characters or one item."""
    context = items.sparkSession.sparkContext
    block, used = [], 0
    rows = items.select(F.col(id_col), F.col(text_col).cast("string"))
    for key, text in rows.toLocalIterator():
        if block and used + len(text or "") > limit:
            yield context.broadcast((block, rate))
            block, used = [], 0
        block.append((key, text))
        used += len(text or "")
    if block:
        yield context.broadcast((block, rate))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, budget, end``: one row per document row and item that
    occurs in it within ``rate`` edits per character of the item.

    ``distance`` is the least found and ``end`` where it ends in the normalised text. Null or
    empty texts match nothing, nor do empty items; repeated items and documents are matched
    each; null ids are carried; empty tables give an empty result.
    """
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    key, item = src.schema["doc"].dataType, items.schema[item_id].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    names = ["doc", "item", "distance", "budget", "end"]
    kinds = [to_arrow_type(key), to_arrow_type(item), pa.int32(), pa.int32(), pa.int64()]
    schema = (f"doc {key.simpleString()}, item {item.simpleString()}, distance int, "
              "budget int, end long")

    def finder(held):
        def run(batches):
            matcher = _matcher(held)
            for b in slices(batches, 1):
                rows = [(doc, *hit) for doc, text in zip(*(c.to_pylist() for c in b.columns))
                        for hit in matcher.hits(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for n, held in enumerate(_blocks(items, item_id, item_text, rate, block_chars)):
        found = src.mapInArrow(finder(held), schema)
        out = found if not n else out.unionByName(found)
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_id), "distance",
                      "budget", "end")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", rate: float = RATE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, all columns unchanged, whatever their names.

    A null or empty text holds no item and stays; null and empty items occur nowhere; repeated
    rows are judged each; without items all rows stay, an empty table gives an empty result."""
    at = docs.columns.index(text_col)

    def keeper(held):
        def run(batches):
            matcher = _matcher(held)
            for b in slices(batches, at):
                yield b.filter(pa.array([not matcher.hits(t) for t in b.column(at).to_pylist()],
                                        pa.bool_()))
        return run

    for held in _blocks(items, item_id, item_text, rate, block_chars):
        docs = docs.mapInArrow(keeper(held), docs.schema)
    return docs
