"""Scalar string functions, all JVM-native Column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------------------
# Whitespace as Python's ``str.isspace`` / ``re`` ``\s`` sees it: ASCII controls \t \n \v \f \r,
# the separators U+001C..U+001F, space, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000. Java's ``\s`` is ASCII-only and ``(?U)\s`` misses
# U+001C..U+001F, so the class is spelled out. The same text is valid RE2 (DuckDB).
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Footer phrases, matched unanchored and case-insensitively against every cell.
FOOTER_PHRASES = ("report creator", "page ", "run time", "generated by", "end of report",
                  "confidential", "rows selected")
# Word that normalises to an empty value (any case).
NONE_WORD = "none"
# ----------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ident(name: str) -> Column:
    """A column by its exact name, even with dots, spaces or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def collapse_ws(c) -> Column:
    """Every whitespace run (Python's definition) becomes one space; ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_CLASS + "+", " "))


def norm_text(c) -> Column:
    """NULL, blank and the word ``none`` (any case) → ``''``; whitespace runs → one space.

    The collapsed text is referenced once (an anchored replace instead of a comparison plus
    a branch), so inside higher-order functions the regex runs once per value. Only ASCII
    letters lower-case to ``none``, so ``(?i)`` without Unicode case folding is exact.
    """
    s = collapse_ws(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.regexp_replace(s, "^(?i)" + NONE_WORD + "$", "")


def canon_header(c) -> Column:
    """Header comparison form: lower case with spaces and hyphens removed."""
    return F.translate(F.lower(_col(c)), " -", "")


def blank_to_null(c) -> Column:
    """Trim ASCII spaces; an empty result becomes NULL."""
    t = F.trim(_col(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def null_safe(c) -> Column:
    """String view used in predicates: NULL → ``''``."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip_zero_fraction(c) -> Column:
    """``12.00``→``12``, ``12.``→``12``; ``12.50`` kept."""
    return F.regexp_replace(_col(c), r"\.0*$", "")


def footer_pattern(phrases=FOOTER_PHRASES) -> str:
    """Case-insensitive alternation of literal phrases (regex metacharacters escaped)."""
    import re

    return "(?i)(" + "|".join(re.escape(p) for p in phrases) + ")"
