"""Token counts by rank-synchronous array merging.

Texts are cut into pre-tokens; a worker holds all pre-tokens it hasn't met yet as one ragged
integer array (flat symbols plus sequence starts). In each round every sequence finds the
lowest merge rank among its adjacent pairs and all sequences apply their own lowest pair at
once; a sequence without a mergeable pair leaves, and its surviving symbols are its count.
A sequence of over ``LONG`` symbols (an unbroken run of letters, say) has as many rounds as
ranks that occur in it: its positions are kept by rank, so a round touches only the positions of
the lowest one and their neighbours.
Counts of pre-tokens are kept in a bounded dictionary, so a frequent one is merged once.

A pair can only be merged by a rank higher than those that made its parts, so applying all
occurrences of the lowest pair together gives what one-at-a-time merging gives.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import slices

# Fixed value: the byte-level pre-token pattern of the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+"
                 r"|\s+(?!\S)|\s+")
CACHE_SIZE = 400_000
LONG = 1 << 10
NONE = np.int64(1 << 40)
# These four are no white space to the vocabulary's library, but are to Python.
_CONTROL = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else the next free
    code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class RankMerger:
    """Byte-level merges of one vocabulary file, applied to many sequences at once."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        self.first = np.array([vocab[s] for s in byte_symbols()], np.int64)
        self.base = np.int64(max(vocab.values()) + 1)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def long_count(self, piece: bytes) -> int:
        """Surviving symbols of one long piece: the same rounds over an index of its positions
        by rank."""
        sym = self.first[np.frombuffer(piece, np.uint8)]
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NONE)   # of the pair that begins here; none where no symbol is left
        rank[:-1] = self.ranks_of(sym[:-1], sym[1:])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def place(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            values, starts = np.unique(rank[at], return_index=True)
            for value, some in zip(values.tolist(), np.split(at, starts[1:])):
                if value in index:
                    index[value].append(some)
                else:
                    index[value] = [some]
                    heapq.heappush(heap, value)

        place(np.arange(n))
        left = n
        while heap:
            low = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(low)))
            at = at[rank[at] == low]
            if not len(at):
                continue
            # a pair such as "aaa" overlaps itself: take every second hit of a run
            head = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
            offset = np.arange(len(at)) - np.repeat(head, np.diff(np.r_[head, len(at)]))
            hit = at[offset % 2 == 0]
            gone = after[hit]
            sym[hit] = self.made[low]
            rank[gone] = NONE
            after[hit] = after[gone]
            inner = after[hit] < n
            before[after[hit[inner]]] = hit[inner]
            left -= len(hit)
            rank[hit[~inner]] = NONE
            near = np.unique(np.r_[hit[inner], before[hit][before[hit] >= 0]])
            rank[near] = self.ranks_of(sym[near], sym[after[near]])
            place(near)
        return left

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Surviving symbols of every piece (none is empty)."""
        out = np.zeros(len(pieces), np.int64)
        short = []
        for i, piece in enumerate(pieces):
            if len(piece) > LONG:
                out[i] = self.long_count(piece)
            else:
                short.append(i)
        out[short] = self._counts([pieces[i] for i in short])
        return out

    def _counts(self, pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.int64)
        if not pieces:
            return out
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sym = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            rank = np.full(len(sym), NONE)
            inner = owner[1:] == owner[:-1]
            rank[:-1][inner] = self.ranks_of(sym[:-1][inner], sym[1:][inner])
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == NONE
            out[owner[starts[over]]] = sizes[over]
            live = np.repeat(~over, sizes)
            hit = np.flatnonzero(live & (rank == np.repeat(lowest, sizes)))
            if not len(hit):
                break
            # a pair such as "aaa" overlaps itself: take every second hit of a run
            head = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
            offset = np.arange(len(hit)) - np.repeat(head, np.diff(np.r_[head, len(hit)]))
            hit = hit[offset % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            live[hit + 1] = False
            sym, owner = sym[live], owner[live]
        return out


class Counter:
    """Tokens of whole texts; special strings inside a text count as one token each."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.cache: dict[str, int] = {}
        self.wide = regex.compile(PATTERN)
        self.ascii = re.compile(ASCII_PATTERN)
        special = sorted(self.merger.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and its number of special strings."""
        find = (self.ascii if text.isascii() and not _CONTROL.search(text) else self.wide).findall
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            return find(text), 0
        return [p for part in parts for p in find(part)], len(parts) - 1

    def counts(self, texts: list[str | None]) -> list[int]:
        cut = [self.pieces(t) if t else ([], 0) for t in texts]
        if len(self.cache) > CACHE_SIZE:
            self.cache.clear()
        cache = self.cache
        new = list({p for ps, _ in cut for p in ps if p not in cache})
        step = 200_000
        for i in range(0, len(new), step):
            block = new[i:i + step]
            cache.update(zip(block, self.merger.counts([p.encode() for p in block]).tolist()))
        return [sum(map(cache.__getitem__, ps)) + special for ps, special in cut]


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row.

    ``path`` is a byte-level vocabulary file that every executor has. Texts are counted whole;
    a null or empty text has 0 bytes and 0 tokens, a null id stays null, repeated rows are
    counted each, other columns are not read, and an empty table gives an empty result.
    """

    def run(batches):
        counter = _counter(path)
        for b in slices(batches, 1, 4 << 20):
            texts = b.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n = counter.counts(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(n, pa.int64())],
                                             ["key", "n_bytes", "n_tokens"])

    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["key"].dataType.simpleString()
    out = src.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
