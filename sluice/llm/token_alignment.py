"""Cross-tokenizer alignment: groups of tokens of two vocabularies over the same bytes.

Both tokenizers encode a text; the ends of their tokens, as byte offsets, go into dictionaries
from end to token index. The ends that both dictionaries hold, sorted, slice the two id lists
into groups of the same bytes, and each group links every token of one side with every token of
the other.

A text is cut into units before each space that follows a non-space: neither tokenizer joins
tokens over such a place (checked for the vocabulary, otherwise a text is one unit), so the
tokens and groups of a text are those of its units, and a unit that was met before is not
encoded again.

Links of a document become one row per pair of ids. How many documents hold a pair is counted
over the corpus; the most frequent pairs are sent to every task, up to a fixed number of them,
all others are joined.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, quoted, slices
from sluice.llm.token_counts import PATTERN, byte_symbols

# Pairs that are sent to every task: 16 bytes each and what a hash table needs.
HEAD = 1 << 18
CHUNK = 1 << 20
KEPT = 1 << 22
# Links of a group beyond which its distinct ids are paired instead of its tokens.
WIDE = 1 << 12
_GAP = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_BLANKS = re.compile(r"\s{1000}")


class Side:
    """Encodes texts that begin with a space; ``table`` has the bytes of every id, ``splits``
    says that no token holds a space after a non-space."""

    table: list[bytes]
    splits: bool

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def encode_joined(self, texts: list[str]) -> np.ndarray:
        """Ids of units one after the other, as those of the joined units."""
        return np.concatenate(self.encode(texts))

    def spelled(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


class ByteSide(Side):
    """A byte-level vocabulary file (.json) of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        spec = json.loads(open(path, encoding="utf-8").read())
        value = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["id"]: t["content"] for t in spec.get("added_tokens", ())}
        vocab = self.library.get_vocab()
        self.table = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.table[i] = special[i].encode() if i in special else bytes(
                value[c] for c in piece)
        self.quick = self._quick(spec, special)
        self.splits = self.quick is not None or spec["pre_tokenizer"]["type"] == "ByteLevel"

    def _quick(self, spec, special):
        """The same merges in a faster library, where ids are ranks and pre-tokens are those of
        :data:`PATTERN`; None elsewhere."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        pre = spec["pre_tokenizer"]
        if (pre["type"] != "ByteLevel" or not pre.get("use_regex", True)
                or pre.get("add_prefix_space") or spec.get("normalizer")
                or any(a >= b for a, b in zip(made, made[1:]))):
            return None
        import tiktoken

        ranks = {b: i for i, b in enumerate(self.table) if i not in special}
        return tiktoken.Encoding("byte-side", pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # the faster library's pattern engine has no room for very long blanks
        if self.quick is None or any(map(_BLANKS.search, texts)):
            found = (e.ids for e in self.library.encode_batch(texts, add_special_tokens=False))
        else:
            found = map(self.quick.encode_ordinary, texts)
        return [np.array(ids, np.int64) for ids in found]

    def encode_joined(self, texts: list[str]) -> np.ndarray:
        return self.encode(["".join(texts)])[0]


class PieceSide(Side):
    """A sentencepiece model (.model) that puts a space before a text. Texts come with that
    space and are encoded without it."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.table = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i)
                      else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.splits = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids = self.library.encode([t[1:] for t in texts], num_threads=1)
        return [np.array(x, np.int64) for x in ids]

    def encode_joined(self, texts: list[str]) -> np.ndarray:
        ids = self.library.encode([t[1:] for t in texts], num_threads=1)
        return np.fromiter(itertools.chain.from_iterable(ids), np.int64)


def units(text: str) -> list[str]:
    """The text with a space in front, cut before every space that follows a non-space (a
    single space at the end stays with what is before it)."""
    return _GAP.split(" " + text)


def group_bounds(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of either side up to each common end, ascending."""
    at_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return (np.array([at_a[e] for e in common], np.int64),
            np.array([at_b[e] for e in common], np.int64))


def _runs(keys: list[np.ndarray], weights: np.ndarray) -> list[np.ndarray]:
    """Distinct rows of the keys, sorted, and the sum of their weights."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    if not len(order):
        return [*keys, weights]
    new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]
    starts = np.flatnonzero(new)
    return [*(k[starts] for k in keys), np.add.reduceat(weights[order], starts)]


class Aligner:
    """Two vocabularies, applied to batches of texts. Units that were met before are kept with
    their groups, up to ``KEPT`` characters of listings."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _side(path_a), _side(path_b)
        self.cuts = self.a.splits and self.b.splits
        self.len_a, self.len_b = (np.array([len(x) for x in s.table], np.int64)
                                  for s in (self.a, self.b))
        self.size_b = len(self.b.table)
        # an id as it is written in a listing: inside a side, at a group's end
        self.written = np.array(
            [f"{i}{end}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for end in ends
             for i in range(len(side.table))], object)
        self._clear()

    def _clear(self):
        self.code: dict[str, int] = {}
        self.listing: list[str | None] = []
        self.size = 0
        self.counts = np.zeros((0, 4), np.int64)
        self.links = [np.zeros(0, np.int64)] * 3
        self.starts = np.zeros(1, np.int64)

    def _learn(self, new: list[str]):
        # units that end with a space cannot stand before others
        last = [u for u in new if u[-1].isspace()]
        new = [u for u in new if not u[-1].isspace()]
        counts, links = [self.counts], [self.links]
        for some in (new, last):
            chunk, used = [], 0
            for i, unit in enumerate(some):
                chunk.append(unit)
                used += len(unit)
                if used >= CHUNK or i == len(some) - 1:
                    n, listing, found = self._chunk(chunk, some is new and self.cuts)
                    self.code.update(zip(chunk, range(len(self.listing),
                                                      len(self.listing) + len(chunk))))
                    links.append([found[0] + len(self.listing), *found[1:]])
                    counts.append(n)
                    self.listing += listing
                    self.size += sum(len(x or "") for x in listing)
                    chunk, used = [], 0
        self.counts = np.concatenate(counts)
        self.links = [np.concatenate(x) for x in zip(*links)]
        self.starts = np.searchsorted(self.links[0], np.arange(len(self.listing) + 1))

    def _encode(self, texts: list[str], together: bool):
        """Units that either side spells, and the ids of these, one after the other."""
        if together:
            ids_a, ids_b = self.a.encode_joined(texts), self.b.encode_joined(texts)
            if self.a.spelled(ids_a) == "".join(texts).encode() == self.b.spelled(ids_b):
                return list(range(len(texts))), ids_a, ids_b
        got_a, got_b = self.a.encode(texts), self.b.encode(texts)
        keep = [k for k, text in enumerate(texts) if self.a.spelled(got_a[k]) == text.encode()
                == self.b.spelled(got_b[k])]
        return keep, *(np.concatenate([np.zeros(0, np.int64), *(g[k] for k in keep)])
                       for g in (got_a, got_b))

    def align(self, texts: list[str | None]):
        """Per text ``n_a, n_b, n_groups, n_links`` and the listing's digest, and the linked
        pairs as sorted arrays ``text, id of A * size of B + id of B, times``."""
        if self.size > KEPT:
            self._clear()
        parts = [(units(t) if self.cuts else [" " + t]) if t else [] for t in texts]
        met = dict.fromkeys(itertools.chain.from_iterable(parts))
        self._learn([u for u in met if u not in self.code])
        codes = [list(map(self.code.__getitem__, p)) for p in parts]
        digests = []
        for i, own in enumerate(codes):
            listed = list(map(self.listing.__getitem__, own))
            if None in listed:
                codes[i] = listed = []
            digests.append(
                hashlib.sha256(";".join(listed).encode()).hexdigest() if listed else "")
        flat = np.fromiter(itertools.chain.from_iterable(codes), np.int64)
        owner = np.repeat(np.arange(len(texts)), list(map(len, codes)))
        counts = np.zeros((len(texts), 4), np.int64)
        if len(flat):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            counts[owner[first]] = np.add.reduceat(self.counts[flat], first)
        doc, unit, times = _runs([owner, flat], np.ones(len(flat), np.int64))
        # the rows of a unit's links lie together
        start = self.starts[unit]
        n = self.starts[unit + 1] - start
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return counts, digests, _runs([np.repeat(doc, n), self.links[1][at]],
                                      self.links[2][at] * np.repeat(times, n))

    def _chunk(self, texts: list[str], together: bool):
        """Counts and listing of every unit (None where its tokens do not spell it), and its
        linked pairs as sorted arrays ``unit, pair, times``."""
        counts = np.zeros((len(texts), 4), np.int64)
        listing: list[str | None] = [None] * len(texts)
        keep, ids_a, ids_b = self._encode(texts, together)
        if not keep:
            return counts, listing, [np.zeros(0, np.int64)] * 3
        ends_a = np.cumsum(self.len_a[ids_a])
        stop_a, stop_b = group_bounds(ends_a, np.cumsum(self.len_b[ids_b]))
        start_a, start_b = np.r_[0, stop_a[:-1]], np.r_[0, stop_b[:-1]]
        wide_a, wide_b = stop_a - start_a, stop_b - start_b
        # a unit ends with a group
        ends = np.cumsum([len(texts[k].encode()) for k in keep])
        unit = np.array(keep)[np.searchsorted(ends, ends_a[stop_a - 1])]
        first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        for column, values in enumerate((wide_a, wide_b, np.ones_like(unit), wide_a * wide_b)):
            counts[unit[first], column] = np.add.reduceat(values, first)
        lists = self._listings(ids_a, ids_b, start_a, start_b, stop_a, stop_b, first)
        for k, written in zip(keep, lists):
            listing[k] = written

        narrow = np.flatnonzero(wide_a * wide_b <= WIDE)
        n = (wide_a * wide_b)[narrow]
        group = np.repeat(narrow, n)
        at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        pair = (ids_a[start_a[group] + at // wide_b[group]] * self.size_b
                + ids_b[start_b[group] + at % wide_b[group]])
        found = [(unit[group], pair, np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(wide_a * wide_b > WIDE):
            a, times_a = np.unique(ids_a[start_a[g]:stop_a[g]], return_counts=True)
            b, times_b = np.unique(ids_b[start_b[g]:stop_b[g]], return_counts=True)
            found.append((np.full(len(a) * len(b), unit[g]),
                          (a[:, None] * self.size_b + b[None, :]).ravel(),
                          (times_a[:, None] * times_b[None, :]).ravel()))
        owner, pair, times = (np.concatenate(x) for x in zip(*found))
        return counts, listing, _runs([owner, pair], times)

    def _listings(self, ids_a, ids_b, start_a, start_b, stop_a, stop_b, first):
        """The groups of each unit as written: ``a1,a2|b1;a3|b2,b3``."""
        size_a = len(self.a.table)
        last_a, last_b = (np.zeros(len(x), np.int64) for x in (ids_a, ids_b))
        last_a[stop_a - 1] = last_b[stop_b - 1] = 1
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + np.repeat(start_b, stop_a - start_a)] = (
            ids_a + last_a * size_a)
        codes[np.arange(len(ids_b)) + np.repeat(stop_a, stop_b - start_b)] = (
            2 * size_a + ids_b + last_b * self.size_b)
        written = self.written[codes].tolist()
        starts = (start_a + start_b)[first].tolist()
        for s, e in zip(starts, starts[1:] + [len(written)]):
            yield "".join(written[s:e])[:-1]


def _side(path: str):
    return PieceSide(path) if path.endswith(".model") else ByteSide(path)


@functools.lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _aligned(batches, path_a: str, path_b: str):
    aligner = _aligner(path_a, path_b)
    for batch in slices(batches, 1, 1 << 20):
        texts = batch.column(1).to_pylist()
        counts, digests, (doc, pair, times) = aligner.align(texts)
        offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
        links = pa.ListArray.from_arrays(
            pa.array(offsets), pa.StructArray.from_arrays(
                [pa.array(pair), pa.array(times)], ["pair", "times"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(digests), links],
            ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, groups_sha256, links`` per row; ``links`` is the
    array of its distinct linked pairs ``pair, times``, the pair being the id of A times the
    size of B plus the id of B. Nulls and texts without tokens as in :func:`alignment`."""
    src = docs.select(quoted(id_col).alias("key"), quoted(text_col).cast("string").alias("text"))
    return src.mapInArrow(
        lambda batches: _aligned(batches, path_a, path_b),
        f"key {src.schema['key'].dataType.simpleString()}, n_a long, n_b long, n_groups long, "
        "n_links long, groups_sha256 string, links array<struct<pair: long, times: long>>")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: rows that hold a pair, and whether no pair of its id of A has more.
    An id of A has at most as many pairs as B has ids, which bounds the window's groups."""
    counts = rows.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(F.floor(F.col("pair") / size_b))
    return counts.withColumn("best", F.col("n") == F.max("n").over(own))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest count that no more than ``most`` pairs reach (counts are taken in quarters
    of a power of two: a few hundred rows for the driver)."""
    size = F.floor(F.log2("n") * 4).cast("int")
    sizes = sorted(counts.groupBy(size.alias("size")).count().collect(), reverse=True)
    seen, low = 0, None
    for size, n in sizes:
        seen += n
        if seen > most:
            break
        low = size
    return 1 << 62 if low is None else int(np.ceil(2 ** (low / 4)))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
              text_col: str = "text", head: int = HEAD) -> DataFrame:
    """Per row ``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: tokens
    of either side, groups, links of single tokens, how many of these have the count that is the
    highest of their id of A, and the sum of their counts, a pair's count being the rows of
    ``docs`` that hold it linked.

    Texts are encoded whole, special strings as plain text. A null or empty text, and one whose
    tokens of either side do not spell it, has no tokens: zeros and an empty digest. Repeated
    rows count each, also in the counts; a null id stays null; other columns are not read; an
    empty table gives an empty result. ``head`` bounds the pairs that are broadcast, not the
    result.
    """
    rows = cut(aligned(docs, path_a, path_b, id_col, text_col).withColumn(
        "row", F.monotonically_increasing_id()), "aligned")
    counts = cut(pair_counts(rows, _aligner(path_a, path_b).size_b), "pair-counts")
    low = frequent_from(counts, head)
    links = rows.select("row", F.inline("links"))
    often = F.broadcast(counts.filter(F.col("n") >= low))
    seldom = counts.filter(F.col("n") < low)

    def sums(found):
        return found.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    near = sums(links.join(often, "pair"))
    far = sums(links.join(often.select("pair"), "pair", "left_anti").join(seldom, "pair"))
    both = near.unionByName(far).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    stats = rows.drop("links").join(both, "row", "left").fillna(0, ["n_best", "count_sum"])
    return stats.select(F.col("key").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
                        "n_best", "count_sum", "groups_sha256")
