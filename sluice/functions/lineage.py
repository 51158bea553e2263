"""Lineage columns: bill cycle from a file name, UUIDv7 ids, file metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------------------
CYCLE_PREFIX = "BC"      # bill cycle = prefix + last two characters of the file stem
UUID_VERSION = "7"
# ----------------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_stem(name) -> Column:
    """File name without its last extension, like ``os.path.splitext(name)[0]``.

    A leading dot does not start an extension (``.env`` stays ``.env``) and only the
    last dot counts (``a.b.txt`` → ``a.b``).
    """
    return F.regexp_replace(_col(name), r"^(.*[^.].*)\.[^.]*$", "$1")


def decoded_path(path) -> Column:
    """A scan's ``_metadata.file_path`` (URI-encoded: ``a b`` → ``a%20b``) as a plain path.

    Percent escapes are decoded; ``+`` is literal in URI paths, so it is protected from the
    form-style decoder first.
    """
    return F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))


def canonical_path(path) -> Column:
    """One spelling for a scan's ``_metadata.file_path`` and a listing's URI
    (``inputFiles()``): ``file:///x`` becomes ``file:/x``, percent escapes are decoded."""
    return decoded_path(F.regexp_replace(_col(path), r"^file:///", "file:/"))


def last_segment(path) -> Column:
    """Last segment of an already plain path."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def base_name(path) -> Column:
    """Last segment of a scan file path, decoded (``file:/in/a%20b_01.txt`` → ``a b_01.txt``)."""
    return F.regexp_extract(decoded_path(path), r"([^/]*)$", 1)


def bill_cycle(name) -> Column:
    """``'BC'`` + the last two characters of the file stem (``inv_x_01.txt`` → ``BC01``)."""
    return F.concat(F.lit(CYCLE_PREFIX), F.right(file_stem(name), F.lit(2)))


def uuid7() -> Column:
    """RFC 9562 UUIDv7 as a JVM expression.

    48-bit Unix milliseconds of the query start, version nibble 7, 12 random bits,
    the RFC variant (8..b) and 62 random bits taken from Spark's seeded ``uuid()``
    (a re-run task regenerates the same ids).
    """
    ms = F.lpad(F.lower(F.hex(F.unix_millis(F.current_timestamp()))), 12, "0")
    rnd = F.expr("uuid()")
    return F.concat(
        F.substring(ms, 1, 8), F.lit("-"), F.substring(ms, 9, 4), F.lit("-" + UUID_VERSION),
        F.substring(rnd, 16, 3), F.lit("-"), F.substring(rnd, 20, 17),
    )


UUID7_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def is_uuid7(c) -> Column:
    return _col(c).rlike(UUID7_PATTERN)
