"""Language ID by rank-order profiles.

A text's 1- to 3-grams of letters (words padded with one mark on either side) are ranked by
count; a language's profile is the ranking of its training texts' n-grams. A document's first
``PROFILE`` n-grams are compared to every profile by out-of-place distance: the sum of rank
differences, ``PROFILE`` for an n-gram the profile lacks.

An n-gram is one integer of 21 bits per letter, so counting is sorting; equal counts rank by
that integer.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import held_out, slices

PROFILE = 300
UNKNOWN = "und"
LEAST = 0.2
MARK = ord("_")
STRETCH = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def grams(text: str) -> np.ndarray:
    """All 1- to 3-grams of a text's words; empty if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    padded = np.full(len(points) + 2, MARK, np.int64)
    padded[1:-1] = points
    letter = np.zeros(len(padded), bool)
    letter[1:-1] = _letters()[points]
    padded[~letter] = MARK
    two = (padded[:-1] << 21) | padded[1:]
    three = (two[:-1] << 21) | padded[2:]
    return np.concatenate([padded[letter], two[letter[:-1] | letter[1:]],
                           three[letter[1:-1]]])


def stretches(text: str, length: int = STRETCH):
    """The text cut before spaces and line breaks into stretches of about ``length`` characters
    (longer where there is neither); no n-gram crosses such a place."""
    start = 0
    while len(text) - start > length:
        ends = [i for i in (text.find(c, start + length) for c in " \n") if i >= 0]
        if not ends:
            break
        yield text[start:min(ends)]
        start = min(ends)
    yield text[start:]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, ascending, and their counts; a long text is counted stretch
    by stretch, so memory follows its distinct n-grams."""
    codes = n = np.zeros(0, np.int64)
    for part in stretches(text):
        own, times = np.unique(grams(part), return_counts=True)
        if len(codes):
            own, at = np.unique(np.concatenate([codes, own]), return_inverse=True)
            times = np.bincount(at, np.concatenate([n, times])).astype(np.int64)
        codes, n = own, times
    return codes, n


def ranking(text: str, size: int = PROFILE) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first, ties by n-gram."""
    codes, n = counted(text)
    return codes[np.argsort(-n, kind="stable")[:size]]


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
             size: int = PROFILE) -> dict[str, list[int]]:
    """Ranked n-grams by language over all rows with text and language.

    What reaches the driver is bounded: languages x ``size`` integers.
    """

    def run(batches):
        for b in slices(batches, 1, 2 << 20):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if len(text) > STRETCH:
                    codes, n = counted(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes),
                         pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
                else:
                    by.setdefault(lang, []).append(grams(text))
            for lang, parts in by.items():
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes),
                     pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    src = docs.select(F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).cast("string").alias("text")).dropna()
    counts = src.mapInArrow(run, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    out: dict[str, list[int]] = {}
    for lang, _, gram in sorted((r["lang"], r["rank"], r["gram"]) for r in top.collect()):
        out.setdefault(lang, []).append(gram)
    return out


class Judge:
    """Out-of-place distances of a text to all profiles."""

    def __init__(self, learned: dict[str, list[int]], size: int = PROFILE):
        self.size, self.langs = size, sorted(learned)
        self.codes = np.unique(np.array([g for v in learned.values() for g in v], np.int64))
        self.place = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.place[np.searchsorted(self.codes, learned[lang]), k] = np.arange(len(learned[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = ranking(text, self.size) if text else ()
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        place = self.place[at]
        off = np.abs(place - np.arange(len(own))[:, None])
        off[~known[:, None] | (place < 0)] = self.size
        total = off.sum(axis=0)
        best = int(np.argmin(total))
        return self.langs[best], float(1 - total[best] / (self.size * len(own)))


def identify(docs: DataFrame, learned: dict[str, list[int]], id_col: str = "doc_id",
             text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``id_col, lang_pred, score`` of every row, from its whole text alone.

    ``score`` is 1 less the distance over its maximum; equal distances go to the language
    first by code point. A null text, or one without a letter, gives ``und`` and 0, and so
    does every text if nothing was learned. Ids may be null or repeat; an empty table gives
    an empty result.
    """

    def run(batches):
        judge = Judge(learned, size)
        for b in slices(batches, 1):
            got = [judge(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], ["key", "lang_pred", "score"])

    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["key"].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, lang_pred string, score double") \
        .withColumnRenamed("key", id_col)


def keep(docs: DataFrame, learned: dict[str, list[int]], text_col: str = "text",
         least: float = LEAST, size: int = PROFILE) -> DataFrame:
    """The rows of ``docs`` whose language is known: not ``und``, and with a score of ``least``
    at least (a text in no learned language shares few n-grams with any profile). All columns
    stay as they are, whatever their names.

    A null or empty text, or one without a letter, goes; so does every row if nothing was
    learned. Repeated rows and null ids are judged each by their text; an empty table gives an
    empty result. The bound is low: it takes out texts in other scripts, but most texts in Latin
    letters reach it, also in languages that were not learned."""
    at = docs.columns.index(text_col)

    def run(batches):
        judge = Judge(learned, size)
        for b in slices(batches, at):
            got = [judge(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([g[0] != UNKNOWN and g[1] >= least for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def evaluate(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learns from all rows outside the held-out fold and labels every row: ``doc_id, held_out,
    lang_pred, score``. Null texts and languages are not learned from; a null id is never held
    out; other rules as :func:`identify`."""
    out = held_out(F.col("doc_id"), folds, fold)
    found = identify(docs, profiles(docs.filter(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
