"""Table and file sinks: truncate-and-load, replace by cycle, CSV backup, dual write (K1–K6)."""

from __future__ import annotations

import json
import logging
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DATABASE_ERROR, IntakeError
from ..operators.align import align, cast_failures, failure_counts, unknown_columns
from ..session import scratch_path, shared_root
from ..sources.files import delete, list_files, list_folders, make_folder, qualify

log = logging.getLogger(__name__)


def _check_names(df: DataFrame, schema, target: str, skip: str | None) -> None:
    extra = [c for c in unknown_columns(df, schema) if not skip or c.lower() != skip.lower()]
    if extra:
        # Validate before writing: an overwrite would empty the table first (trap T6).
        raise IntakeError(DATABASE_ERROR, f"columns not in {target}: {extra}", target)


def target_schema(spark: SparkSession, table: str, on_error: str = "raise") -> T.StructType | None:
    """Columns of a catalog table. With ``on_error="warn"`` a table that cannot be read is
    logged and None: the load then goes on without alignment (A7)."""
    try:
        return spark.table(table).schema
    except Exception as exc:  # noqa: BLE001 - policy switch
        if on_error != "warn":
            raise
        log.warning("alignment skipped, schema of %s not read: %s", table, exc)
        return None


def _converted(df: DataFrame, schema) -> T.StructType:
    """The target columns whose type differs from that of the column in ``df``."""
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    return T.StructType([f for f in schema.fields
                         if have.get(f.name.lower(), f.dataType) != f.dataType])


def load_rejects(df: DataFrame, schema, target: str, on_cast: str = "raise") -> dict[str, int]:
    """Per target column, how many values cannot be converted to its type (A6): one pass.

    Any reject raises ``database_error`` unless ``on_cast`` is ``"null"``; columns that need
    no conversion are not looked at. The loads of this module count while they write instead.
    """
    typed = _converted(df, schema)
    if not typed.fields:
        return {}
    return _checked(cast_failures(df, typed).first().asDict(), target, on_cast)


def _checked(counts: dict[str, int], target: str, on_cast: str) -> dict[str, int]:
    rejects = {c: n for c, n in counts.items() if n}
    if rejects and on_cast != "null":
        raise IntakeError(DATABASE_ERROR, f"values that do not fit {target}: {rejects}", target)
    return rejects


@contextmanager
def _static_overwrite(spark):
    """An overwrite replaces the whole table, whatever the session says; the setting is put
    back afterwards."""
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "static")
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


@dataclass(frozen=True)
class TableInfo:
    """What a publish has to know of a catalog table."""
    provider: str
    location: str
    external: bool
    partitioned: bool


def table_info(spark: SparkSession, table: str) -> TableInfo:
    about = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    return TableInfo(about.get("provider", "").lower(), about.get("location", ""),
                     about.get("type", "").upper() == "EXTERNAL",
                     bool(about.get("partition_columns")))


#: Folder of the versions of an external table below its own location.
LOADS = "_loads"
#: Folder of the loads that several tables share.
SHARED = "_shared_loads"


def _staged(df: DataFrame, schema, target: str, path: str, fmt: str, on_cast: str,
            by: list[str] | None = None) -> tuple[dict[str, int], int]:
    """Writes ``df``, converted to ``schema``, to ``path`` in one computation that also counts
    its rows and the values that cannot be converted; rejects raise once it is written. Returns
    the rejects and the number of rows."""
    seen, failures = Observation(), failure_counts(df, _converted(df, schema))
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                         *[n.alias(f"_{i}") for i, (_, n) in enumerate(failures)])
    align(counted, schema, cast=True).write.format(fmt).partitionBy(*by or []).save(path)
    got = seen.get
    counts = {c: got.get(f"_{i}") or 0 for i, (c, _) in enumerate(failures)}
    return _checked(counts, target, on_cast), got.get("rows") or 0


def truncate_load(df: DataFrame, table: str, skip: str | None = None,
                  on_cast: str = "raise", extra: str = "raise", if_empty: str = "load",
                  on_schema: str = "raise") -> dict[str, int]:
    """Replace all rows of a catalog table, keeping its definition (K1).

    ``df`` is computed once: its converted rows are written beside the table while the values
    that do not fit its columns are counted, and only then is the table given the new rows.
    Unknown columns (``extra="drop"`` leaves them out) and values that do not fit
    (``on_cast="null"`` loads NULL for them) raise ``database_error`` and leave the table as it
    was. Returns the rejected values per column. ``skip`` names a generated column that is
    loaded as NULL unless ``df`` brings it. ``if_empty="keep"`` leaves the table as it is when
    ``df`` has no row.

    An external table without partitions is switched to the written folder (the folder of the
    load before stays for its readers, older ones go). Any other table is overwritten from the
    written rows by Spark's own commit. ``on_schema="warn"`` goes on where the table's schema
    cannot be read, as a database overwrite does: the table is created with the columns of
    ``df``, or the load fails as ``database_error``.
    """
    spark = df.sparkSession
    schema = target_schema(spark, table, on_schema)
    if schema is None:
        _create(df, table)
        return {}
    if extra != "drop":
        _check_names(df, schema, table, skip)
    info = table_info(spark, table)
    switch = info.external and not info.partitioned and info.provider in ("parquet", "orc")
    root = info.location.split(f"/{LOADS}/")[0].rstrip("/")
    path = f"{root}/{LOADS}/{uuid.uuid4().hex}" if switch else scratch_path(spark, "table-load")
    done = False
    try:
        rejects, n = _staged(df, schema, table, path, info.provider if switch else "parquet",
                             on_cast)
        if n == 0 and if_empty == "keep":
            return rejects
        if switch:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            done = True
            _sweep(spark, root, {path, info.location.rstrip("/")})
        else:
            with _static_overwrite(spark):
                spark.read.schema(schema).parquet(path).write.insertInto(table, overwrite=True)
    finally:
        if not done:
            delete(spark, path)
    return rejects


def load_partitions(df: DataFrame, column: str, tables: dict[str, str],
                    on_cast: str = "raise", location: str | None = None) -> dict[str, int]:
    """Truncate-and-load many tables from one write (S7): ``tables`` maps each table to the value
    of ``column`` whose rows it gets.

    The rows are converted, counted and written once, partitioned by ``column``; rejects and
    unknown columns raise before any table is touched; then each table is switched to its
    partition's folder, a catalog operation. That takes external Parquet tables without
    partitions and of one definition; where one is not, the rows are written once as they are
    and every table is loaded from its own folder.
    """
    spark = df.sparkSession
    infos = {t: table_info(spark, t) for t in tables}
    schemas = {t: spark.table(t).schema for t in tables}
    name, one = next(iter(schemas.items()))
    if any(schemas[t] != one or info.provider != "parquet" or info.partitioned
           or not info.external for t, info in infos.items()):
        return _load_each(df, column, tables, on_cast)
    _check_names(df, one, name, column)
    first = infos[name].location.rstrip("/")
    base = first.split(f"/{SHARED}/")[0] if f"/{SHARED}/" in first else first.rsplit("/", 1)[0]
    root = (location or f"{base}/{SHARED}/{name}").rstrip("/")
    path = f"{root}/{uuid.uuid4().hex}"
    wide = T.StructType([*one.fields, T.StructField(column, T.StringType())])
    done = False
    try:
        rejects, _ = _staged(df, wide, name, path, "parquet", on_cast, [column])
        for t, value in tables.items():
            folder = f"{path}/{column}={value}"
            make_folder(spark, folder)
            spark.sql(f"ALTER TABLE {t} SET LOCATION '{folder}'")
            done = True
            spark.catalog.refreshTable(t)
    finally:
        if not done:
            delete(spark, path)
    shown = [qualify(spark, x) + "/" for x in (
        path, *(i.location for i in infos.values()))]
    for old in list_folders(spark, root):
        if not any(x.startswith(old + "/") for x in shown):
            delete(spark, old)
    return rejects


def _load_each(df: DataFrame, column: str, tables: dict[str, str], on_cast: str) -> dict[str, int]:
    """The tables one by one, each from its folder of one write."""
    spark, total = df.sparkSession, {}
    path = scratch_path(spark, "load-each")
    data = T.StructType([f for f in df.schema.fields if f.name != column])
    try:
        df.write.partitionBy(column).parquet(path)
        for t, value in tables.items():
            folder = f"{path}/{column}={value}"
            make_folder(spark, folder)
            for c, n in truncate_load(spark.read.schema(data).parquet(folder), t,
                                      on_cast=on_cast).items():
                total[c] = total.get(c, 0) + n
    finally:
        delete(spark, path)
    return total


def _create(df: DataFrame, table: str) -> None:
    try:
        df.write.mode("overwrite").saveAsTable(table)
    except Exception as exc:
        raise IntakeError(DATABASE_ERROR, f"{type(exc).__name__}: {exc}", table) from exc


def _sweep(spark: SparkSession, root: str, keep: set[str]) -> None:
    """Removes the rows of older loads below a table's own folder."""
    if root not in keep:
        for path in list_files(spark, root):
            delete(spark, path)
    for path in list_folders(spark, f"{root}/{LOADS}"):
        if path not in {qualify(spark, k) for k in keep}:
            delete(spark, path)


def append(df: DataFrame, table: str, on_cast: str = "raise", extra: str = "raise") -> dict[str, int]:
    """Append rows, converted to the table's types (K2); checks as :func:`truncate_load`.

    Where a column has to be converted, the rows are written to the shared folder and counted
    in one computation, then appended from there; otherwise they are appended directly.
    """
    spark = df.sparkSession
    schema = spark.table(table).schema
    if extra != "drop":
        _check_names(df, schema, table, None)
    if not _converted(df, schema).fields:
        align(df, schema, cast=True).write.insertInto(table, overwrite=False)
        return {}
    path = scratch_path(spark, "table-append")
    try:
        rejects, _ = _staged(df, schema, table, path, "parquet", on_cast)
        spark.read.schema(schema).parquet(path).write.insertInto(table, overwrite=False)
    finally:
        delete(spark, path)
    return rejects


def replace_partitions(df: DataFrame, path: str, key="billcycle", fmt: str = "parquet") -> None:
    """Replace only the ``key`` values present in ``df`` in a partitioned folder (K3).

    Dynamic partition overwrite: other cycles are kept and each cycle is replaced whole; no SQL
    text is built from data (trap T8). New files appear when the job commits; on a store
    without atomic renames a reader may see a cycle between its old and new files.
    ``key`` may be a list (e.g. cycle and file: replace one file's rows of a cycle).
    """
    keys = [key] if isinstance(key, str) else list(key)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).format(fmt).save(path))


def replace_keys(existing: DataFrame, incoming: DataFrame, key: str = "billcycle") -> DataFrame:
    """Frame form of K3: existing rows of untouched keys, plus all incoming rows.

    The replaced keys (one small row each) are computed once, into the shared folder; the
    anti-join is a broadcast where their size allows, else adaptive execution splits hot keys.
    """
    shared_root(incoming.sparkSession)
    keys = incoming.select(key).distinct().checkpoint(eager=True)
    return existing.join(keys, key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def backup_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header, overwrite (K4). One output file only when asked (``files=1``)."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)


def quote_table(name: str) -> str:
    """Quoted SQL name (K5): a schema, if any, ends at the first dot; every non-empty part is
    quoted by itself, with its own quotes doubled."""
    head, _, tail = name.partition(".")
    return ".".join('"%s"' % part.replace('"', '""') for part in (head, tail) if part)


@contextmanager
def staged(df: DataFrame, name: str = "staged"):
    """``df`` written once as Parquet to the shared folder, for several readers (K6 / O3): a
    lost executor costs none of it. Removed at the end."""
    path = scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)
