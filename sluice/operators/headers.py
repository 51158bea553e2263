"""Fuzzy header detection, one report (file / sheet) at a time, on the executors.

For every report the first ``SAMPLE_ROWS`` rows are gathered into one row (a bounded group:
50 rows per report, shuffled as a partial aggregate). All further work is a projection of
that row with higher-order functions, so reports are matched in parallel and nothing passes
through the driver:

* candidate blocks: start row 0..14 × height 1..9 that fit the sample; per column, the
  normalised non-empty cells of the block joined by a space (H1);
* pair scores against the target headers in their comparison form: equal 1.0, one contains
  the other 0.8, at least three distinct shared characters 0.7 (H2);
* greedy one-to-one assignment by score descending, ties by (column, target order) (H3);
* best block: most assignments, the first block in (start, height) order on ties (H4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canon_header, footer_pattern, norm_text, null_safe, FOOTER_PHRASES
from .stamp import FILE_COL, ROW_COL

# --- fixed values (must equal the reference's behaviour) -------------------------------
SAMPLE_ROWS = 50          # rows per report looked at for the header
MAX_START = 15            # header blocks start in rows 0..14
MAX_HEIGHT = 9            # and are 1..9 rows high
SCORE_EQUAL = 1.0
SCORE_CONTAINS = 0.8
SCORE_SHARED = 0.7
MIN_SHARED_CHARS = 3
# ----------------------------------------------------------------------------------------

_MAPPING_TYPE = "array<struct<c:int,t:int,th:string,score:double>>"


def parse_headers(target_headers) -> list[str]:
    """Comma-separated (or list) target headers, normalised like :func:`norm_text`, blanks
    and the none word dropped, later repeats dropped (a header can be matched once)."""
    items = target_headers.split(",") if isinstance(target_headers, str) else list(target_headers)
    words = [" ".join(str(h).split()) for h in items if h is not None]
    kept = [w for w in words if w and w.lower() != "none"]
    return list(dict.fromkeys(kept))


def _targets_literal(targets: list[str]) -> Column:
    """Targets with their comparison form and its distinct characters (constant-folded)."""
    return F.array(*[
        F.struct(F.lit(i).alias("t"), F.lit(th).alias("th"), canon_header(F.lit(th)).alias("k"),
                 _chars(canon_header(F.lit(th))).alias("ch"))
        for i, th in enumerate(targets)])


def _chars(s: Column) -> Column:
    return F.array_distinct(F.filter(F.split(s, ""), lambda x: x != ""))


def pair_score(a: Column, b: Column, a_chars: Column | None = None,
               b_chars: Column | None = None) -> Column:
    """Score of two comparison forms (0.0 when below every rule)."""
    a_chars = _chars(a) if a_chars is None else a_chars
    b_chars = _chars(b) if b_chars is None else b_chars
    return (F.when(a == b, F.lit(SCORE_EQUAL))
             .when(F.contains(a, b) | F.contains(b, a), F.lit(SCORE_CONTAINS))
             .when(F.size(F.array_intersect(a_chars, b_chars)) >= MIN_SHARED_CHARS,
                   F.lit(SCORE_SHARED))
             .otherwise(F.lit(0.0)))


def sample_reports(grid: DataFrame, file_col: str = FILE_COL, row_col: str = ROW_COL,
                   cells_col: str = "cells", partitions: int | None = None) -> DataFrame:
    """``(file, rows ARRAY<STRUCT<r, cells>>)``: each report's first 50 rows in order, cells
    already normalised.

    The sample is tiny in bytes but detection is CPU work, so it is hash-partitioned by
    report into an explicit number of partitions (default: the cluster's cores), which
    adaptive execution does not coalesce into one task; the grouping reuses that
    partitioning, so there is a single shuffle of at most 50 rows per report.
    """
    n = partitions or grid.sparkSession.sparkContext.defaultParallelism
    # Cells are normalised once per row here, before grouping, not once per candidate block.
    return (grid.filter(F.col(row_col) <= SAMPLE_ROWS)
            .select(file_col, row_col, F.transform(cells_col, norm_text).alias("cells"))
            .repartition(n, file_col)
            .groupBy(file_col)
            .agg(F.array_sort(F.collect_list(
                F.struct(F.col(row_col).alias("r"), F.col("cells").alias("cells")))).alias("rows")))


def _window_cols(rows: Column, start: Column, height: Column, width: Column) -> Column:
    block = F.slice(rows, start + 1, height)
    return F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda c: F.array_join(
            F.filter(F.transform(block, lambda r: F.coalesce(F.get(r["cells"], c), F.lit(""))),
                     lambda p: p != ""), " "))


def _windows(rows: Column) -> Column:
    n = F.size(rows)
    width = F.greatest(F.array_max(F.transform(rows, lambda r: F.size(r["cells"]))), F.lit(1))
    return F.flatten(F.transform(
        F.sequence(F.lit(0), F.least(F.lit(MAX_START - 1), n - 1)),
        lambda s: F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(MAX_HEIGHT)), lambda h: s + h <= n),
            lambda h: F.struct(s.alias("start"), h.alias("height"),
                               _window_cols(rows, s, h, width).alias("cols")))))


def _candidates(cols: Column, targets: Column, min_score: float = SCORE_SHARED,
                strict: bool = False) -> Column:
    """Sorted candidates ``(c, t, th, score)`` scoring at least ``min_score`` (default 0.7).

    ``strict`` drops columns whose comparison form is empty (a cell of dashes, trap T5).
    """
    named = F.filter(F.transform(cols, lambda s, i: F.struct(i.alias("c"), s.alias("s"))),
                     lambda x: x["s"] != "")
    keyed = F.transform(named, lambda x: F.struct(
        x["c"].alias("c"), canon_header(x["s"]).alias("k")))
    return _pairs(keyed, targets, min_score, strict)


def _pairs(keyed: Column, targets: Column, min_score: float, strict: bool) -> Column:
    """Candidates of columns ``(c, k)``, ``k`` being the comparison form. Each column's
    character set is computed once, not once per target."""
    if strict:
        keyed = F.filter(keyed, lambda x: x["k"] != "")
    keyed = F.transform(keyed, lambda x: F.struct(x["c"].alias("c"), x["k"].alias("k"),
                                                   _chars(x["k"]).alias("ch")))
    pairs = F.flatten(F.transform(keyed, lambda x: F.transform(targets, lambda t: F.struct(
        (-pair_score(x["k"], t["k"], x["ch"], t["ch"])).alias("o"), x["c"].alias("c"),
        t["t"].alias("t"), t["th"].alias("th")))))
    kept = F.filter(pairs, lambda p: (p["o"] <= -min_score) & (p["o"] < 0))
    return F.transform(F.array_sort(kept), lambda p: F.struct(
        p["c"].alias("c"), p["t"].alias("t"), p["th"].alias("th"), (-p["o"]).alias("score")))


def _assign(cands: Column) -> Column:
    """Greedy one-to-one fold: keep a candidate when its column and target are both unused."""
    init = F.struct(F.array().cast("array<int>").alias("cs"),
                    F.array().cast("array<int>").alias("ts"),
                    F.array().cast(_MAPPING_TYPE).alias("m"))
    folded = F.aggregate(cands, init, lambda acc, x: F.when(
        F.array_contains(acc["cs"], x["c"]) | F.array_contains(acc["ts"], x["t"]), acc
    ).otherwise(F.struct(F.array_append(acc["cs"], x["c"]).alias("cs"),
                         F.array_append(acc["ts"], x["t"]).alias("ts"),
                         F.array_append(acc["m"], x).alias("m"))))
    return folded["m"]


def header_windows(samples: DataFrame, file_col: str = FILE_COL) -> DataFrame:
    """One row per candidate block: ``(file, start, height, cols)`` (H1)."""
    return samples.select(file_col, F.inline(_windows(F.col("rows"))))


def header_scores(windows: DataFrame, targets: list[str], min_score: float = SCORE_SHARED,
                  strict: bool = False) -> DataFrame:
    """Adds ``cands``: sorted (c, t, th, score) pairs scoring at least 0.7 (H2)."""
    return windows.withColumn("cands", _candidates(F.col("cols"), _targets_literal(targets),
                                                   min_score, strict))


def assign_headers(scored: DataFrame) -> DataFrame:
    """Adds ``mapping`` (greedy one-to-one) and ``n`` = its size (H3)."""
    return (scored.withColumn("mapping", _assign(F.col("cands")))
            .withColumn("n", F.size("mapping")))


def _is_target(i: int):
    return lambda x: x["t"] == F.lit(i)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _best(targets: Column, n_targets: int, min_score: float, strict: bool) -> Column:
    """The first block with the most assignments, over ``rows`` (``cells`` and their comparison
    forms ``keys``) and ``filled`` (numbers of each row's non-empty columns).

    A fold over the blocks in order, with a bound: a block assigns at most as many columns as
    it has non-empty ones, and at most all targets. A block that cannot beat the best so far is
    not scored, and nothing is once every target is assigned. ``strict`` breaks count ties by
    total score (trap T18: a first header row that alone covers every target), so it goes on
    until the total cannot grow either.
    """
    rows = F.col("rows")
    init = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("total"), F.lit(-1).alias("start"),
                    F.lit(0).alias("height"), F.array().cast(_MAPPING_TYPE).alias("mapping"))

    def columns(b: Column) -> Column:
        return F.array_sort(F.array_distinct(
            F.flatten(F.slice("filled", b["start"] + 1, b["height"]))))

    def scored(b: Column, cols: Column) -> Column:
        # the comparison form of joined cells is that of the cells, joined
        def key(block: Column) -> Column:
            return F.transform(cols, lambda c: F.struct(c.alias("c"), F.array_join(
                F.transform(block, lambda r: F.coalesce(F.get(r["keys"], c), F.lit(""))),
                "").alias("k")))
        keyed = _let(F.slice(rows, b["start"] + 1, b["height"]), key)
        return _let(_assign(_pairs(keyed, targets, min_score, strict)), lambda m: F.struct(
            F.size(m).alias("n"),
            F.aggregate(m, F.lit(0.0), lambda a, x: a + x["score"]).alias("total"),
            b["start"].alias("start"), b["height"].alias("height"), m.alias("mapping")))

    def better(w: Column, acc: Column) -> Column:
        if not strict:
            return w["n"] > acc["n"]
        return (w["n"] > acc["n"]) | ((w["n"] == acc["n"]) & (w["n"] > 0)
                                      & (w["total"] > acc["total"] + 1e-9))

    def step(acc: Column, b: Column) -> Column:
        done = acc["total"] >= n_targets - 1e-9 if strict else acc["n"] >= n_targets
        hopeless = (lambda cols: F.size(cols) < acc["n"]) if strict else (
            lambda cols: F.size(cols) <= acc["n"])
        return F.when(done, acc).otherwise(_let(columns(b), lambda cols: F.when(
            hopeless(cols), acc).otherwise(_let(scored(b, cols), lambda w: F.when(
                better(w, acc), w).otherwise(acc)))))

    n = F.size(rows)
    blocks = F.flatten(F.transform(
        F.sequence(F.lit(0), F.least(F.lit(MAX_START - 1), n - 1)),
        lambda s: F.transform(
            F.filter(F.sequence(F.lit(1), F.lit(MAX_HEIGHT)), lambda h: s + h <= n),
            lambda h: F.struct(s.alias("start"), h.alias("height")))))
    return F.aggregate(blocks, init, step)


def detect_headers(samples: DataFrame, targets: list[str], file_col: str = FILE_COL,
                   min_score: float = SCORE_SHARED, strict: bool = False) -> DataFrame:
    """Best header block per report: ``(file, header_end, n, mapping, tidx)`` (H1–H4).

    ``header_end`` is the 0-based index of the last header row (-1 when nothing matched),
    ``tidx[k]`` the column mapped to target ``k`` (NULL when unmapped). Comparison forms are
    made once per cell; the steps are separate projections so each costly array is computed
    once per report.
    """
    keyed = samples.select(
        file_col, F.transform("rows", lambda r: F.struct(
            r["cells"].alias("cells"), F.transform(r["cells"], canon_header).alias("keys")))
        .alias("rows"),
        F.transform("rows", lambda r: F.filter(
            F.transform(r["cells"], lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull()))
        .alias("filled"))
    best = keyed.select(file_col, _best(_targets_literal(targets), len(targets), min_score,
                                        strict).alias("b"))
    b = F.col("b")
    tidx = F.array(*[
        F.try_element_at(F.filter(b["mapping"], _is_target(i)), F.lit(1))["c"]
        for i in range(len(targets))])
    return best.select(
        file_col,
        F.when(b["n"] > 0, b["start"] + b["height"] - 1).otherwise(F.lit(-1)).alias("header_end"),
        b["n"].alias("n"), b["mapping"].alias("mapping"), tidx.alias("tidx"))


def mapping_text(mapping: Column) -> Column:
    """Stable text of a mapping: ``000=Account No;001=Customer Name`` (column order)."""
    return F.array_join(F.array_sort(F.transform(
        mapping, lambda x: F.concat(F.lpad(x["c"].cast("string"), 3, "0"), F.lit("="), x["th"]))),
        ";")


# --- cleaning after detection ------------------------------------------------------------
def skip_preamble(grid: DataFrame, detected: DataFrame, file_col: str = FILE_COL,
                  row_col: str = ROW_COL) -> DataFrame:
    """Keep rows after each report's header block (F2); reports without a match drop out.

    ``detected`` has one row per report. Spark broadcasts it where its size allows; otherwise
    adaptive execution splits the partition of a report that holds a large share of all rows.
    """
    det = detected.filter(F.col("header_end") >= 0).select(file_col, "header_end", "tidx")
    joined = grid.join(det, file_col)
    return joined.filter(F.col(row_col) > F.col("header_end") + 1)


def is_footer(cells: Column, phrases=FOOTER_PHRASES) -> Column:
    pat = footer_pattern(phrases)
    return F.exists(cells, lambda x: null_safe(x).rlike(pat))


def is_blank(cells: Column) -> Column:
    """No cell holds a character (a cell of spaces counts as data)."""
    return ~F.exists(cells, lambda x: null_safe(x) != "")


def drop_footers(df: DataFrame, cells_col: str = "cells", phrases=FOOTER_PHRASES) -> DataFrame:
    return df.filter(~is_footer(F.col(cells_col), phrases))


def drop_blank_rows(df: DataFrame, cells_col: str = "cells") -> DataFrame:
    return df.filter(~is_blank(F.col(cells_col)))


def project_mapped(df: DataFrame, targets: list[str], cells_col: str = "cells",
                   keep=(FILE_COL, ROW_COL)) -> DataFrame:
    """One trimmed column per target header (named by it), from the mapped cell."""
    cols = [F.trim(F.get(F.col(cells_col), F.get(F.col("tidx"), i))).alias(th)
            for i, th in enumerate(targets)]
    return df.select(*cols, *[k for k in keep if k in df.columns])
