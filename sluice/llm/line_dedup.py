"""Line dedup by a segment-partition edit join, with DataFrame functions only.

Equal lines (trimmed) form a class. A class is near another if their edit distance is at most
``TAU``. A line of length L is split into TAU + 1 even segments; if two lines are near, one
segment of the shorter occurs unchanged in the longer, and shifted by little: an index holds
(L, segment number, segment) of every class, and a class probes the index of each length from
its own down to TAU less with the few substrings that can match. Candidates that agree in all but TAU
of some ``PIECES`` are verified by a banded bit-parallel edit distance.

Lines are ordered by (document id, line number). Of each class all but the first line are
dropped, and so is that one if a near line of another class comes before it. One earlier near
line is enough, so a class is first compared to the earliest classes of its index entry only,
and to the others there only if those don't settle it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import cut, fresh, let, quoted

TAU = 2
MIN_CHARS = 32
PIECES = (8, 64)
# Keys, or words of 64 bits, that are sent to every task.
SENT = 1 << 19
# The low bits of a line's place tell rows with one id and different texts apart.
PRINT = 16
BLANK = " \t\x0b\x0c\r"


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, at, line`` of all trimmed lines of ``min_chars`` characters at least; ``at`` orders
    a document's lines."""
    text = F.col(text_col).cast("string")
    # the print is taken before the split: beside it, it would be taken again for each line
    rows = docs.select(F.col(id_col).alias("id"), _print(text).alias("print"),
                       F.split(text, "\n").alias("parts"))
    rows = rows.select("id", "print", F.posexplode("parts")).filter(F.length("col") >= min_chars)
    at = F.shiftleft(F.col("pos").cast("long"), PRINT).bitwiseOR(F.col("print"))
    rows = rows.select("id", at.alias("at"), _trimmed(F.col("col")).alias("line"))
    return rows.filter(F.length("line") >= min_chars)


def _trimmed(line: Column) -> Column:
    """The line without blanks at its ends; most have none, which two looks tell."""
    ends = reduce(Column.__or__, [line.startswith(c) | line.endswith(c) for c in BLANK])
    return F.when(ends, F.btrim(line, F.lit(BLANK))).otherwise(line)


def _print(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << PRINT) - 1))


def segment_keys(line: Column, tau: int = TAU) -> list[Column]:
    """Index entries of a line (``tau + 1``), then its other probes."""
    def key(length: Column, i: int, shift: int) -> Column:
        size = F.floor(length / (tau + 1)).cast("int")
        longer = length % (tau + 1)  # the last segments are one longer
        begin = i * size + F.greatest(F.lit(0), longer - (tau + 1 - i))
        own = size + F.when(longer >= tau + 1 - i, 1).otherwise(0)
        return F.xxhash64(length, F.lit(i), F.substring(line, begin + shift + 1, own))

    n = F.length(line)
    index = [key(n, i, 0) for i in range(tau + 1)]
    probes = [key(n - less, i, shift) for less in range(tau + 1) for i in range(tau + 1)
              for shift in range(max(-i, less - (tau - i)), min(i, less + tau - i) + 1)
              if less or shift]
    return index + probes


def within(a: Column, b: Column, tau: int = TAU) -> Column:
    """Whether two texts, their lengths at most ``tau`` apart, have an edit distance of at most
    ``tau``.

    Bit vectors of vertical differences cover the diagonals from ``tau + 1`` above to ``tau``
    below the main one; the score follows the lowest diagonal to the last row, then that row.
    """
    width = 2 * tau + 2
    full, top = (1 << width) - 1, width - 1

    def step(x: Column, y: Column, m: Column, s: Column, j: Column) -> Column:
        here = F.get(y, j - 1)
        equal = reduce(Column.__add__, [
            F.when(F.get(x, j + (tau - top + k - 1)) == here, 1 << k).otherwise(0)
            for k in range(width)])

        def moved(eq: Column) -> Column:
            d0 = (((eq.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]))
                  .bitwiseOR(eq).bitwiseOR(s["vn"])).bitwiseAND(F.lit(full))
            return let(d0, settled)

        def settled(d0: Column) -> Column:
            hp = s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"]))).bitwiseAND(F.lit(full))
            return let(hp, lambda h: placed(d0, h))

        def placed(d0: Column, hp: Column) -> Column:
            hn, low = d0.bitwiseAND(s["vp"]), F.shiftright(d0, 1)
            past = j + tau - m
            row = lambda v: _bit(v, F.lit(top) - past)
            score = s["score"] + F.when(past <= 0, 1 - _bit(d0, F.lit(top))) \
                .otherwise(row(hp) - row(hn))
            vp = hn.bitwiseOR(F.bitwise_not(low.bitwiseOR(hp))).bitwiseAND(F.lit(full))
            return F.struct(vp.alias("vp"), low.bitwiseAND(hp).alias("vn"), score.alias("score"))

        return let(equal, moved)

    begin = F.struct(F.lit(full ^ ((1 << (top - tau)) - 1)).alias("vp"), F.lit(0).alias("vn"),
                     F.lit(tau).alias("score"))
    chars = lambda t: F.split(t, "")
    return let(chars(a), lambda x: let(chars(b), lambda y: F.aggregate(
        F.sequence(F.lit(1), F.size(y)), begin,
        lambda s, j: step(x, y, F.size(x), s, j), lambda s: s["score"] <= tau)))


def may_be_within(a: Column, b: Column, tau: int = TAU) -> Column:
    """False for most pairs that are not within ``tau`` edits, never for one that is: of the even
    pieces of ``a`` each edit spoils one, the others occur in ``b`` shifted by ``tau`` at most.
    A few long pieces are looked at first, then many short ones."""
    def met(n: Column, i: Column, pieces: int) -> Column:
        begin = F.floor(n * i / pieces).cast("int")
        size = F.floor(n * (i + 1) / pieces).cast("int") - begin
        first = F.greatest(begin - tau, F.lit(0))
        return F.contains(F.substring(b, first + 1, begin + size + tau - first),
                          F.substring(a, begin + 1, size))

    def agree(n: Column, pieces: int) -> Column:
        return F.size(F.filter(F.sequence(F.lit(0), F.lit(pieces - 1)),
                               lambda i: met(n, i, pieces))) >= pieces - tau

    few, many = PIECES
    return let(F.length(a), lambda n: agree(n, few) & agree(n, many))


def _bit(value: Column, at: Column) -> Column:
    return F.call_function("shiftright", value, at).bitwiseAND(F.lit(1))


def _admitted(rows: DataFrame, key: Column, wanted: DataFrame, most: int = SENT) -> DataFrame:
    """The rows whose ``key`` (a long) is in the column ``key`` of ``wanted``, and where that has
    more than ``most`` rows, some others: then ``most`` words of 64 bits are sent to all tasks
    instead of the keys."""
    if wanted.count() <= most:
        return rows.join(F.broadcast(wanted.select(F.col("key").alias("sent"))),
                         key == F.col("sent"), "left_semi")
    word = lambda k: F.shiftright(k, 6).bitwiseAND(F.lit(most - 1))
    bit = lambda k: k.bitwiseAND(F.lit(63)).cast("int")
    words = wanted.groupBy(word(F.col("key")).alias("sent")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), bit(F.col("key")))).alias("bits"))
    met = rows.join(F.broadcast(words), word(key) == F.col("sent"))
    return met.filter(_bit(F.col("bits"), bit(key)) == 1).select(*rows.columns)


def near_classes(docs: DataFrame, id_col: str, text_col: str, tau: int, min_chars: int,
                 most: int = SENT):
    """Classes (``digest, who, n``) and the classes to drop (``who``): ``who`` is the place
    (``id, at``) of a class's first line. ``most`` (a power of two) bounds what is broadcast."""
    every = lines(docs, id_col, text_col, min_chars)
    first = F.min(F.struct("id", "at", "keys"))
    classes = cut(every.select("id", "at", F.unhex(F.md5("line")).alias("digest"),
                               F.array(*segment_keys(F.col("line"), tau)).alias("keys"))
                  .groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
                  .select("digest", F.struct("f.id", "f.at").alias("who"), "n", "f.keys"),
                  "lines-classes")
    entries = classes.select("who", F.posexplode("keys").alias("pos", "key")) \
        .select("who", (F.col("pos") <= tau).alias("indexed"), "key")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"),
                                        F.count_if("indexed").alias("held")) \
        .filter("n > 1 and held > 0").select("key")
    shared = cut(shared, "lines-shared")
    some = _admitted(entries, F.col("key"), shared, most)
    members = cut(some.join(shared, "key"), "lines-members")

    # the lines of all members
    wanted = cut(members.select("who").distinct(), "lines-wanted")
    ids = cut(wanted.select(F.xxhash64("who.id").alias("key")).distinct(), "lines-ids")
    from_docs = _admitted(docs, F.xxhash64(quoted(id_col)), ids, most)
    texts = lines(from_docs, id_col, text_col, min_chars).select(
        F.struct("id", "at").alias("who"), "line")
    # rows that repeat an id and its text repeat its lines
    texts = cut(wanted.join(texts, "who").dropDuplicates(["who"]), "lines-texts")
    near = may_be_within(F.col("x"), F.col("y"), tau)

    # the earliest indexed class of an entry meets all its members, the earliest of all members
    # meets the indexed ones
    hubs = members.groupBy("key").agg(F.min("who").alias("any"), F.count(F.lit(1)).alias("n"),
                                      F.min(F.when(F.col("indexed"), F.col("who"))).alias("own"))
    hubs = cut(hubs, "lines-hubs")
    met = members.join(hubs, "key")
    pairs = met.select(F.col("own").alias("a"), F.col("who").alias("b")).union(
        met.filter("indexed").select("any", "who"))
    pairs = pairs.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").filter(near)
    gone = cut(both.filter(within(F.col("x"), F.col("y"), tau)).select(F.col("b").alias("who"))
               .distinct(), "lines-gone")
    # what is left meets the other members before it; only pairs that may be near leave the join
    crowd = members.join(hubs.filter("n > 2"), "key").join(texts, "who")
    left = crowd.join(gone, "who", "left_anti").select(
        F.col("who").alias("b"), F.col("indexed").alias("ib"), "key", F.col("line").alias("y"))
    crowd = crowd.select(F.col("who").alias("a"), F.col("indexed").alias("ia"), "key",
                         F.col("line").alias("x"), "own", "any")
    tested = (F.col("a") == F.col("own")) | ((F.col("a") == F.col("any")) & F.col("ib"))
    rest = crowd.join(left, "key").filter(
        (F.col("a") < F.col("b")) & (F.col("ia") | F.col("ib")) & ~tested & near) \
        .select("a", "b", "x", "y").dropDuplicates(["a", "b"])
    more = rest.filter(within(F.col("x"), F.col("y"), tau)).select(F.col("b").alias("who")).distinct()
    return classes.select("digest", "who", "n"), cut(gone.union(more), "lines-near")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, print, dropped`` (sorted line numbers from 0) of documents that lose lines."""
    classes, gone = near_classes(docs, id_col, text_col, tau, min_chars)
    gone = gone.withColumn("near", F.lit(True))
    classes = classes.join(gone, "who", "left").withColumn("near", F.col("near").isNotNull())
    bad = cut(classes.filter("n > 1 or near").select("digest", "who", "near"), "lines-bad")
    places = lines(docs, id_col, text_col, min_chars) \
        .select("id", "at", F.unhex(F.md5("line")).alias("digest"))
    key = F.xxhash64("digest")
    places = _admitted(places, key, bad.select(key.alias("key"))).join(bad, "digest")
    places = places.filter(F.col("near") | (F.struct("id", "at") != F.col("who"))).distinct()
    return places.groupBy("id", F.col("at").bitwiseAND(F.lit((1 << PRINT) - 1)).alias("print")) \
        .agg(F.array_sort(F.collect_list(F.shiftright("at", PRINT).cast("int"))).alias("dropped"))


def _joined(rows: DataFrame, key: str, mark: str, dropped: DataFrame, lost: str) -> DataFrame:
    """``rows`` with the dropped line numbers of their document, if any, as ``lost``."""
    of, at = fresh(rows, "of", "at")
    dropped = dropped.toDF(of, at, lost)
    return rows.join(dropped, F.col(key).eqNullSafe(F.col(of)) & (F.col(mark) == F.col(at)),
                     "left").drop(of, at)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
           min_chars: int = MIN_CHARS) -> DataFrame:
    """``id_col, n_lines, n_kept, dropped_lines`` of every row: the numbers (from 0, joined by
    commas) of lines that equal or nearly equal an earlier line.

    Lines under ``min_chars`` characters when trimmed are always kept. A null text has no line,
    an empty one has one. Null ids come first; rows that repeat an id and its text are one
    document; an empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("key"), _print(text).alias("print"),
                       F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    rows = _joined(rows, "key", "print",
                   dropped_lines(docs, id_col, text_col, tau, min_chars), "dropped")
    lost = F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped"))
    return rows.select(F.col("key").alias(id_col), F.col("n_lines").cast("long"),
                       (F.col("n_lines") - lost).cast("long").alias("n_kept"),
                       F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped_lines"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
          min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the dropped lines taken out of the texts, all other columns unchanged. A
    document that loses all its lines is left out.

    A null text has no line and stays; an empty one too (its one line is under ``min_chars``).
    Rows that repeat an id and its text lose the same lines; null ids come first in the order
    of lines; an empty table gives an empty result."""
    mark, lost = fresh(docs, "mark", "lost")
    rows = docs.withColumn(mark, _print(F.col(text_col).cast("string")))
    rows = _joined(rows, id_col, mark, dropped_lines(docs, id_col, text_col, tau, min_chars), lost)
    parts = F.split(F.col(text_col), "\n")
    rows = rows.filter(F.col(lost).isNull() | (F.size(lost) < F.size(parts)))
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(lost, i)), "\n")
    rows = rows.withColumn(text_col, F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(kept))
    return rows.select(*map(quoted, docs.columns))
