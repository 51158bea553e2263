"""Document fingerprints by I-Match, with DataFrame functions only.

Terms whose document frequency lies in a band (neither common nor rare) form the lexicon. A
document keeps its lexicon terms, distinct and sorted, and hashes them once per lexicon subset.
Subsets are drawn at random at several rates: at rate 1/r every term falls in one of r cells by
a hash (one draw or more), and the first cells are the subsets. Two documents are compared at the sparsest rate at
which enough of their subsets hold a term; their likeness is the share of subsets that hash
alike.

The band bounds the lexicon: a term in it occurs in ``LOW`` of all documents at least, so it
has at most (mean distinct terms of a document) / ``LOW`` terms, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import cut, let, words

LOW, HIGH = 0.01, 0.2
# cells per rate, how many of them are subsets, draws
RATES = ((1, 1, 1), (4, 4, 4), (16, 16, 1), (64, 16, 1), (256, 16, 1))
ENOUGH = 4
BUCKETS = 64  # ranges of ids: BUCKETS x BUCKETS at most
ROWS_PER_BUCKET = 1000


def terms(text: Column) -> Column:
    """Hashes of a text's lower-cased words."""
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW,
            high: float = HIGH) -> list[int]:
    """Term hashes whose document frequency is from ``low`` to ``high`` of all rows. Frequencies
    cover all rows; only terms inside the band reach the driver, a bounded number."""
    total = docs.count()
    df = docs.select(F.explode(F.array_distinct(terms(F.col(text_col)))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = df.filter(F.col("df").between(low * total, high * total) & (F.col("df") > 1))
    return sorted(r["term"] for r in band.select("term").collect())


def signatures(text: Column, lex: list[int]) -> Column:
    """32-bit hashes of the sorted distinct lexicon terms, one per subset, 0 for a subset that
    holds none of the text's terms. A text without lexicon terms keeps all its terms."""
    return let(terms(text), lambda every: let(_kept(every, lex), lambda kept: F.flatten(F.array(
        *[_subsets(kept, cells, n, draw) for cells, n, draws in RATES for draw in range(draws)]))))


def _kept(every: Column, lex: list[int]) -> Column:
    if not lex:
        return F.array_sort(F.array_distinct(every))
    return let(F.array_distinct(F.filter(every, lambda t: t.isin(lex))), lambda inside: F.array_sort(
        F.when(F.size(inside) > 0, inside).otherwise(F.array_distinct(every))))


def _subsets(kept: Column, cells: int, n: int, draw: int) -> Column:
    """Hashes of the first ``n`` of ``cells`` random subsets of sorted terms."""
    def hashed(part: Column) -> Column:
        return let(part, lambda p: F.when(F.size(p) > 0, F.xxhash64(p).bitwiseAND(
            F.lit(0xFFFFFFFF))).otherwise(F.lit(0).cast("long")))

    if cells == 1:
        return F.array(hashed(kept))
    in_cell = F.transform(kept, lambda t: F.struct(
        t.alias("t"), F.pmod(F.xxhash64(t, F.lit(cells + draw)), F.lit(cells)).alias("c")))
    if n < cells:
        in_cell = F.filter(in_cell, lambda x: x["c"] < n)
    return let(in_cell, lambda some: F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda j: hashed(F.filter(some, lambda x: x["c"] == j))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subsets at the sparsest rate at which ``ENOUGH`` subsets hold a term of
    either text; 1 if neither has any term."""
    out, at = F.lit(1.0), 1
    for _, cells, draws in RATES:
        n = cells * draws
        both = F.filter(F.arrays_zip(F.slice(a, at, n).alias("x"), F.slice(b, at, n).alias("y")),
                        lambda p: (p["x"] != 0) | (p["y"] != 0))
        share = let(both, lambda ps: F.when(
            F.size(ps) >= min(n, ENOUGH),
            F.size(F.filter(ps, lambda p: p["x"] == p["y"])) / F.size(ps)))
        out = F.coalesce(share, out)
        at += n
    return out


def as_text(signature: Column) -> Column:
    return F.lower(F.array_join(F.transform(signature, lambda s: F.lpad(F.hex(s), 8, "0")), ""))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, at, text, print`` of every row, and ``next, next_at, next_print`` of the row after
    it by (id, text), for the last row the first.

    Rows are dealt by ranges of ids from quantiles; a window runs inside a range only. Each
    range also gets the rows with the first id of the range after it, marked, so that its last
    row has a successor. Null ids come first, null texts count as empty.
    """
    src = docs.select(F.col(id_col).alias("id"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("at"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = cut(src.select("at"), "imatch-ids")
    n = max(2, min(BUCKETS, round((ids.count() / ROWS_PER_BUCKET) ** 0.5)))
    steps = [i / (n * n) for i in range(1, n * n)]
    found = ids.agg(F.percentile_approx("at", steps, 100_000).alias("q")).first()["q"] or []
    bounds = sorted(set(found))
    coarse = bounds[n - 1::n]
    fine = [[b for b in bounds if (not i or b > coarse[i - 1])
             and (i == len(coarse) or b <= coarse[i])] for i in range(len(coarse) + 1)]
    first = [0]
    for part in fine:
        first.append(first[-1] + len(part))

    def number(values) -> str:
        return "array(" + ", ".join(f"CAST('{v}' AS long)" for v in values) + ")"

    big = F.expr(f"size(filter({number(coarse)}, b -> b < at)) + 1") if coarse else F.lit(1)
    nested = "array(" + ", ".join(map(number, fine)) + ")" if bounds else None
    src = src.withColumn("big", big)
    src = src.withColumn("range", F.expr(
        f"CAST(element_at({number(first)}, big) AS int) "
        f"+ size(filter(element_at({nested}, big), b -> b < at))") if bounds else F.lit(0))
    # first id of each range, and the range before it that holds rows
    lows = sorted((r["range"], r["low"]) for r in src.groupBy("range").agg(
        F.min("at").alias("low")).collect())
    order = [r for r, _ in lows]
    size = (order[-1] + 1) if order else 1
    low, before = [0] * size, [0] * size
    for i, (r, v) in enumerate(lows):
        low[r], before[r] = v, order[i - 1]
    copy = F.expr(f"at = element_at({number(low)}, range + 1)")
    prior = F.expr(f"CAST(element_at({number(before)}, range + 1) AS int)")
    src = src.withColumn("print", F.xxhash64("text")).withColumn("copies", F.when(
        copy, F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("mark")),
                      F.struct(prior.alias("range"), F.lit(1).alias("mark"))))
        .otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("mark")))))
    src = src.select("id", "at", "text", "print", F.explode("copies").alias("c")) \
        .select("id", "at", "text", "print", "c.range", "c.mark")
    run = Window.partitionBy("range").orderBy("mark", "at", "text")
    return src.select("id", "at", "text", "print", "mark", F.lead("text").over(run).alias("next"),
                      F.lead("at").over(run).alias("next_at"),
                      F.lead("print").over(run).alias("next_print")).filter("mark = 0")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 low: float = LOW, high: float = HIGH) -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` of every row.

    The edited text replaces the last quarter (floor of a quarter of the characters) by the
    first as many, or all, of the next row's text. Ids are integers; null ids come first, equal
    ids go by text, a null text counts as empty, the only row is its own successor, an empty
    table gives an empty result. Equal texts have equal fingerprints; texts without words are
    alike.
    """
    lex = lexicon(docs, text_col, low, high)
    rows = with_next(docs, id_col, text_col)
    n, q = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - q),
                      F.substring(F.col("next"), F.lit(1), q))
    rows = rows.withColumn("edited", edited).select(
        "id", "at", "print", "next_at", "next_print", n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        signatures(F.col("text"), lex).alias("own"),
        signatures(F.col("edited"), lex).alias("other"))
    rows = cut(rows, "imatch-rows")
    ahead = rows.select(F.col("at").alias("next_at"), F.col("print").alias("next_print"),
                        F.col("own").alias("ahead")).dropDuplicates(["next_at", "next_print"])
    rows = rows.join(ahead, ["next_at", "next_print"], "left")
    return rows.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("ahead")).alias("near_next"))
