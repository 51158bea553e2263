"""Mixing sources to target weights by Pareto order sampling.

Sources get targets by weight (excess over ``max_copies`` times a source's size is shared out
again). A document's expected copies are ``target / source size`` (times its own weight, if
given): the whole part is allocated to it for certain, the fractional part is its inclusion
probability p. Documents are ranked by the Pareto order ``(u / (1 - u)) / (p / (1 - p))`` with
u a hash of the row, and taken from the front until the source's target in words is filled.

No source is sorted in one task: ranks are cut into ``BUCKETS`` buckets per source, their word
sums (small) place the boundary, and running sums are formed only inside a bucket. Ranks bunch
at one end where inclusion is rare or nearly certain, so buckets are even cuts of the u that
would give the rank at the source's own inclusion probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import SPACE, cut, fresh

BUCKETS = 4096
ROUNDS = 3
# Sources whose plan is sent to every task; with more of them rows are joined by source.
SENT = 1 << 16


def word_count(text):
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, SPACE))).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_copies: int = 3) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    Sources by code point, null last, weigh ``weights`` in turn. Sorted by cap per weight, a
    source is capped where the level of the others would lift it over ``max_copies`` times its
    size; all others stand at one level per weight. The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("pos", F.row_number().over(order))
         .withColumn("weight", turn[(F.col("pos") - 1) % len(weights)])
         .withColumn("cap", F.col("source_size") * F.lit(float(max_copies))))
    rise = Window.orderBy(F.col("cap") / F.col("weight"), "pos")
    upto = rise.rowsBetween(Window.unboundedPreceding, -1)
    rest = rise.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(every)
                               - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    s = s.withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
    s = s.withColumn("level", F.min_by(
        "level", F.when(F.col("fits"), F.col("cap") / F.col("weight"))).over(every))
    return s.select("source", "source_size", F.least(
        F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _ranked(u, p):
    """Pareto order u(1-p) / ((1-u)p), squeezed into (0, 1); p = 0 comes after all others."""
    front = u * (1 - p)
    return F.when(p > 0, front / (front + (1 - u) * p)).otherwise(1 + u)


def _bucket(u, p, typical):
    """Bucket of a rank: it never falls as the rank rises, and where ``p`` is the typical
    inclusion probability of the source the buckets are filled evenly."""
    typical = F.least(F.greatest(typical, F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = u * (1 - p) / ((1 - u) * p) * (typical / (1 - typical))
    even = F.when(p >= 1, F.lit(0.0)).when(p > 0, odds / (1 + odds)).otherwise(1 + u)
    return F.floor(even * BUCKETS)


def _fill(rows: DataFrame, max_copies: int, small) -> DataFrame:
    """One filling round: marks documents in rank order while they fit the source's gap."""
    fit = (~F.col("chosen") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
           & (F.col("whole") < max_copies))
    rows = rows.withColumn("room", F.when(fit, F.col("size")).otherwise(F.lit(0)))
    hist = (rows.filter("room > 0").groupBy("source", "bucket")
            .agg(F.sum("room").alias("words"), F.max("gap").alias("top")))
    upto = Window.partitionBy("source").orderBy("bucket")
    edge = (hist.withColumn("before", F.sum("words").over(upto) - F.col("words"))
            .filter(F.col("before") < F.col("top"))
            .groupBy(F.col("source").alias("of"))
            .agg(F.max("bucket").alias("edge"), F.max("before").alias("before")))
    edge = small(edge)
    run = (Window.partitionBy("source", "bucket").orderBy("rank", "tie", "size")
           .rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("run", F.sum("room").over(run))
    rows = rows.join(edge, F.col("source").eqNullSafe(F.col("of")), "left")
    new = (F.col("room") > 0) & ((F.col("bucket") < F.col("edge")) | (
        (F.col("bucket") == F.col("edge")) & (F.col("before") + F.col("run") <= F.col("gap"))))
    rows = rows.withColumn("new", F.coalesce(new, F.lit(False)))
    return (rows.withColumn("chosen", F.col("chosen") | F.col("new"))
            .drop("room", "run", "of", "edge", "before"))


def _with_gap(rows: DataFrame, small) -> DataFrame:
    """``gap``: words that the source still lacks."""
    held = F.sum(F.col("size") * (F.col("whole") + F.col("chosen").cast("int")))
    gaps = rows.groupBy(F.col("source").alias("of")).agg((F.max("target") - held).alias("gap"))
    return rows.join(small(gaps), F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _closest(rows: DataFrame, max_copies: int, small) -> DataFrame:
    """Takes one more document of a source where that ends nearer to the target."""
    rows = _with_gap(rows, small)
    off = F.abs(F.col("size") - F.col("gap"))
    best = rows.filter(~F.col("chosen") & (F.col("whole") < max_copies) & (off < F.col("gap"))) \
        .groupBy(F.col("source").alias("of")).agg(F.min(F.struct(off, "rank", "row"))["row"]
                                                  .alias("best"))
    rows = rows.join(small(best), F.col("source").eqNullSafe(F.col("of")), "left")
    return rows.withColumn("chosen", F.col("chosen") | F.coalesce(
        F.col("row") == F.col("best"), F.lit(False)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=(1, 2, 3), max_copies: int = 3,
        weight_col: str | None = None, seed: int = 17, keep_tie: bool = False) -> DataFrame:
    """``id_col, size, source_size, target, taken, copies`` for every row.

    ``size`` is the text's words (null: 0), ``taken`` = size x copies with copies from 0 to
    ``max_copies``. ``weight_col`` (positive; null counts as 1) makes inclusion unequal inside
    a source too. Only whole documents are taken: what a source still lacks is refilled in
    ``ROUNDS`` rounds in rank order, then by the document that ends nearest to the target, if
    any ends nearer. Null sources form one source, a null id is an id like others, repeated
    rows are sampled each (equal ones tie and are interchangeable), an empty table gives an
    empty result. Ranks come from a hash of id, text and ``seed``: reruns agree.
    """
    tie = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col).cast("string"))
    own = F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col else F.lit(1.0)
    rows = cut(docs.select(
        F.col(id_col).alias("key"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"), own.alias("own"),
        tie.alias("tie")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.sum(F.col("size") * F.col("own")).alias("mass"))
    plan = source_targets(sizes.select("source", "source_size"), weights, max_copies)
    plan = (plan.join(sizes.select(F.col("source").alias("s2"), "mass"),
                      F.col("source").eqNullSafe(F.col("s2")))
            .select(F.col("source").alias("of"), "source_size", "target", F.coalesce(
                F.col("target") / F.when(F.col("mass") > 0, F.col("mass")),
                F.lit(0.0)).alias("rate")))
    plan = cut(plan, "mix-plan")
    # tables of one row per source
    small = F.broadcast if plan.count() <= SENT else (lambda df: df)
    u = (F.shiftrightunsigned(F.xxhash64("tie", F.lit(seed)), 11) + 0.5) / F.lit(float(1 << 53))
    rows = (rows.join(small(plan), F.col("source").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("expected", F.least(F.col("rate") * F.col("own"),
                                            F.lit(float(max_copies))))
            .withColumn("whole", F.floor(F.col("expected") + 1e-9))
            .withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
            .withColumn("u", u))
    typical = F.try_divide(F.col("target"), F.col("source_size"))
    rows = (rows.withColumn("rank", _ranked(F.col("u"), F.col("p")))
            .withColumn("bucket", _bucket(F.col("u"), F.col("p"), typical - F.floor(typical)))
            .withColumn("chosen", F.lit(False)).withColumn("new", F.lit(False))
            .select("key", "source", "size", "tie", "source_size", "target", "whole", "rank",
                    "bucket", "chosen", "new")
            .withColumn("row", F.monotonically_increasing_id()))
    rows = cut(rows, "mix-ranked")
    for n in range(ROUNDS):
        rows = _fill(_with_gap(rows, small), max_copies, small).drop("gap")
        rows = cut(rows, f"mix-round{n}")
    rows = _closest(rows, max_copies, small)
    copies = (F.col("whole") + F.col("chosen").cast("int")).cast("int")
    out = [F.col("key").alias(id_col), "size", "source_size", "target",
           (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies")]
    return rows.select(*out, *(["tie"] if keep_tie else []))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights=(1, 2, 3), max_copies: int = 3,
          seed: int = 17) -> DataFrame:
    """The documents of the mix with all their columns and ``copies`` (1 or more; named
    ``_copies`` where ``docs`` has such a column). Rows of ``docs`` that repeat an id and its text
    are one document here. Null and empty texts have no words and are never taken for a
    gap; null ids and sources are values like others; an empty table gives an empty result."""
    tie, key, of = fresh(docs, "tie", "key", "of")
    docs = docs.withColumn(tie, F.xxhash64(F.lit(seed), F.col(id_col),
                                           F.col(text_col).cast("string")))
    docs = docs.dropDuplicates([id_col, tie])
    taken = mix(docs, id_col, text_col, source_col, weights, max_copies, seed=seed,
                keep_tie=True).filter("copies > 0")
    taken = taken.select(F.col(id_col).alias(key), F.col("tie").alias(of),
                         F.col("copies").alias(fresh(docs, "copies")[0]))
    return docs.join(taken, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(tie) == F.col(of))) \
        .drop(key, of, tie)
