"""Filter interaction audit: forward-backward path counting over the lattice of filter sets.

A state is the set of filters that have been applied; an edge applies one more. A document that
fails some filters is removed by the edge from a state without any of them, so the counts of
documents by their set of failures give every edge's removals. Forward counts say how many
orders reach a state, backward counts how many lead on from it to the full set: their product
over an edge is the number of orders that use it, which weights its removals for the Shapley
sum. The steps of one order are the edges along its path.

Documents become one row per part and failure set before anything is laid out by order, so the
lattice works on counts only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import UPPER, cut, quoted, words

# Fixed values of the five filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
MARKS = "[#$%&*|]"
LETTERS = "ABCDE"


def paths(k: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state of the lattice of ``k`` filters from the empty set, and
    orders that lead from it to the full set. A state is a bit set."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(1, full + 1):
        forward[state] = sum(forward[state ^ 1 << i] for i in range(k) if state >> i & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | 1 << i] for i in range(k) if not state >> i & 1)
    return forward, backward


def text_failures(text: Column) -> dict[str, Column]:
    """Failures of the filters that look at one text, by letter."""
    text = F.coalesce(text, F.lit(""))
    found = words(text)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(found) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(found)) < MIN_DISTINCT_PERCENT * F.size(found),
        "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(MARKS),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, failures: dict[str, Column],
                   same: Column, id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """``part, failed, docs, good, toxic``: rows of each part by their set of failures, as bits
    in the order of ``failures``; the highest bit is set where a smaller id has the same
    ``same``.

    Equal rows are added up by id and then by digest before the digests' smallest ids meet
    them, so a group of copies is at most a row per part, failure set and label by then.
    """
    bits = sum((F.when(bad, 1 << i).otherwise(0) for i, bad in enumerate(failures.values())),
               F.lit(0))
    slim = docs.select(
        quoted(id_col).alias("key"),
        F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(same.cast("binary"), 256)).alias("digest"), bits.alias("failed"))
    # a null id has no label; its rows spread by their digest instead of meeting in one task
    slim = slim.withColumn("pad", F.when(F.col("key").isNull(), F.xxhash64("digest")).otherwise(0))
    known = labels.groupBy(F.col("doc_id").alias("key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    known = known.filter("key IS NOT NULL").withColumn("pad", F.lit(0).cast("long"))
    rows = slim.join(known, ["key", "pad"], "left").fillna(False, ["good", "toxic"])
    kind = ["digest", "part", "failed", "good", "toxic"]
    by_id = rows.groupBy("key", "pad", *kind).agg(F.count(F.lit(1)).alias("n"))
    named = F.col("key").isNotNull()
    groups = cut(by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("unnamed"),
        F.min(F.when(named, F.struct("key", "n"))).alias("low")), "audit-copies")
    first = groups.groupBy("digest").agg(F.min("low.key").alias("first"))
    # a null id is neither smaller than another nor has it a smaller one
    free = F.col("unnamed") + F.when(F.col("low.key") == F.col("first"),
                                     F.col("low.n")).otherwise(0)
    again = F.col("failed") + (1 << len(failures))
    sides = groups.join(first, "digest").select("part", "good", "toxic", F.explode(F.array(
        F.struct("failed", free.alias("n")),
        F.struct(again.alias("failed"), (F.col("n") - free).alias("n")))).alias("side"))
    n = F.col("side.n")
    return sides.filter(n > 0).groupBy("part", F.col("side.failed").alias("failed")).agg(
        F.sum(n).alias("docs"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def _hit(state: Column, bits: Column) -> Column:
    return state.bitwiseAND(bits) != 0


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """The steps of every order of the filters ``letters`` in every part of ``counts``
    (``part, failed, docs, good, toxic``; bit i of ``failed`` is the i-th letter): ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``, counts as longs, zeros included.

    A part's counts are an array of at most 2^k entries; its edges and then its orders are laid
    out from that row alone, without a shuffle.
    """
    k = len(letters)
    forward, backward = paths(k)
    full = 1 << k
    cells = counts.groupBy("part").agg(
        F.collect_list(F.struct("failed", "docs", "good", "toxic")).alias("cells"))

    def total(where, field="docs"):
        return F.aggregate("cells", F.lit(0).cast("long"),
                           lambda s, c: s + F.when(where(c["failed"]), c[field]).otherwise(0))

    def edge(state: Column, bit: Column) -> Column:
        """What one more filter does to a state."""
        def removed(f):
            return _hit(f, bit) & ~_hit(f, state)
        return F.struct(
            total(lambda f: ~_hit(f, state.bitwiseOR(bit))).alias("kept"),
            total(removed).alias("removed"),
            total(lambda f: _hit(f, bit) & _hit(f, state)).alias("redundant"),
            total(lambda f: f == bit).alias("unique_fails"),
            total(removed, "good").alias("good_lost"),
            total(removed, "toxic").alias("toxic_lost"))

    # edge number: state * k + filter; edges that apply a filter again are never used
    at = F.sequence(F.lit(0), F.lit(full * k - 1))
    edges = cells.select("part", F.transform(at, lambda e: edge(
        F.floor(e / k).cast("int"), F.call_function("shiftleft", F.lit(1), e % k))).alias("edges"))
    through = [forward[s] * backward[s | 1 << i] if not s >> i & 1 else 0
               for s in range(full) for i in range(k)]
    weighed = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.aggregate(
        F.sequence(F.lit(0), F.lit(full - 1)), F.lit(0).cast("long"),
        lambda s, x: s + F.col("edges")[x * k + i]["removed"] * F.element_at(
            F.lit(through), x * k + i + 1)))
    edges = edges.select("part", "edges", weighed.alias("shapley"))

    orders = ["".join(o) for o in itertools.permutations(letters)]
    laid = edges.select("part", "edges", "shapley",
                        F.explode(F.lit(orders)).alias("filter_order"))
    laid = laid.select("*", F.posexplode(F.split("filter_order", "")).alias("at", "letter"))
    before = F.aggregate(F.split(F.substring("filter_order", 1, F.col("at")), ""), F.lit(0),
                         lambda s, c: s + F.when(c == "", 0).otherwise(
                             F.call_function("shiftleft", F.lit(1), F.instr(F.lit(letters), c) - 1)))
    own = F.instr(F.lit(letters), F.col("letter")) - 1
    laid = laid.select("part", "filter_order", (F.col("at") + 1).cast("int").alias("step"),
                       F.col("edges")[before * k + own].alias("edge"),
                       F.col("shapley")[own].alias("shapley"))
    return laid.select("part", "filter_order", "step", "edge.*", "shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """Audit of the five fixed filters (A to D of :func:`text_failures`, E: the text of a
    smaller id again), one row per part, order and step; see :func:`interactions`.

    A null text is empty (words and capitals 0, equal to other empty texts); a null part is the
    empty string; a null id has no label, no smaller id and makes no other a repeat; rows of one
    id and text are not repeats of each other and count each; of several labels of an id any
    positive one counts, null labels do not; other columns are not read; without documents the
    result is empty. Texts are looked at whole.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    counts = failure_counts(docs, labels, text_failures(text), text, id_col, part_col)
    return interactions(counts, LETTERS)
