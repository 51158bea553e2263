"""Per-file outcomes and the consolidated run report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import (CASCADING_FAILURE, EMPTY_DATA, MISSING_FILE, ORCHESTRATION_CHILD_FAILURE,
                      PIPELINE_FAILURE, PROCESSED, IntakeError)
from ..functions.lineage import canonical_path, last_segment
from ..session import scratch_path
from ..sources.files import TASK_SCHEMES, move_to, scheme_of, task_move, task_version
from .stamp import FILE_COL

# --- fixed values: reasons of the reference's outcomes -------------------------------------
REASON_EMPTY = "Fuzzy matcher failed or sheet is blank"
REASON_MISSING = "input object not found"
# ----------------------------------------------------------------------------------------

DISPOSITION_SCHEMA = "path string, status string, reason string, n_rows long"


def row_counts(df: DataFrame, file_col: str = FILE_COL) -> DataFrame:
    """Rows per file (map-side partial counts, one row per file shuffled)."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"))


def input_files(spark: SparkSession, found) -> DataFrame:
    """``path`` of every input file, listed by a scan that reads no content."""
    return spark.read.format("binaryFile").load(found).select("path")


def file_disposition(spark: SparkSession, inputs, data: DataFrame,
                     detected: DataFrame | None = None, missing=(),
                     fail_on_no_rows: bool = True, errors: DataFrame | None = None) -> DataFrame:
    """``(path, filename, status, reason, n_rows, payload)`` for every input file.

    A file is ``empty_data`` when no header matched (``detected.n = 0``) or, with
    ``fail_on_no_rows`` (spreadsheet rule), when no data row survived; missing inputs are
    ``missing_file``; all others ``processed``. ``inputs`` is a list of paths or a frame with
    a ``path`` column. ``errors`` (``_file, reason``) names files that could not be read:
    ``pipeline_failure``. ``payload`` is the JSON error text.
    """
    # Paths are normalised by Spark on both sides (no per-file driver call).
    if not isinstance(inputs, DataFrame):
        inputs = spark.createDataFrame([(p,) for p in inputs], "path string")
    files = inputs.select(canonical_path("path").alias("path"))
    counts = row_counts(data).select(canonical_path(FILE_COL).alias("path"), "n_rows")
    out = files.join(counts, "path", "left")
    if detected is not None:
        out = out.join(detected.select(canonical_path(FILE_COL).alias("path"), "n"), "path",
                       "left")
    else:
        out = out.withColumn("n", F.lit(1))
    n_rows = F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")
    empty = F.coalesce(F.col("n"), F.lit(0)) == 0
    if fail_on_no_rows:
        empty = empty | (n_rows == 0)
    if errors is not None:
        out = out.join(errors.select(canonical_path(FILE_COL).alias("path"),
                                     F.col("reason").alias("_broken")), "path", "left")
    else:
        out = out.withColumn("_broken", F.lit(None).cast("string"))
    broken = F.col("_broken").isNotNull()
    status = F.when(broken, F.lit(PIPELINE_FAILURE)).when(empty, F.lit(EMPTY_DATA)) \
        .otherwise(F.lit(PROCESSED))
    reason = F.when(broken, F.col("_broken")).when(empty, F.lit(REASON_EMPTY))
    out = out.select("path", status.alias("status"), reason.alias("reason"),
                     n_rows.alias("n_rows"))
    if missing:
        gone = spark.createDataFrame([(p, MISSING_FILE, REASON_MISSING, 0) for p in missing],
                                     DISPOSITION_SCHEMA)
        out = out.unionByName(gone)
    return out.select("path", last_segment("path").alias("filename"), "status", "reason",
                      "n_rows", _payload().alias("payload"))


def _payload():
    return F.when(F.col("status") != PROCESSED, F.to_json(F.struct(
        F.col("status"), F.col("path").alias("failed_file_path"), F.col("reason"))))


def with_status(dispositions: DataFrame, old: str, new: str) -> DataFrame:
    """Outcomes with one status replaced by another, payloads too."""
    status = F.when(F.col("status") == old, F.lit(new)).otherwise(F.col("status"))
    return dispositions.withColumn("status", status).withColumn("payload", _payload())


def run_report(dispositions: DataFrame) -> DataFrame:
    """One row: units and failed units; the failures themselves are :func:`run_failures`."""
    return dispositions.agg(F.count(F.lit(1)).alias("n_units"),
                            F.count_if(F.col("status") != PROCESSED).alias("n_failed"))


def run_failures(dispositions: DataFrame, unit_col: str = "filename") -> DataFrame:
    """``(unit, line)`` of every failed unit; ``line`` is ``[unit]: status - reason``."""
    line = F.concat(F.lit("["), F.col(unit_col), F.lit("]: "), F.col("status"), F.lit(" - "),
                    F.coalesce(F.col("reason"), F.lit("")))
    return dispositions.filter(F.col("status") != PROCESSED) \
        .select(F.col(unit_col).alias("unit"), line.alias("line"))


def run_gate(dispositions: DataFrame, shown: int = 100) -> None:
    """Raises ``orchestration_child_failure`` if a unit failed (G3). The message holds the
    counts and the first ``shown`` failures by unit; all are in :func:`run_failures`."""
    n = run_report(dispositions).first()
    if n["n_failed"]:
        lines = run_failures(dispositions).orderBy("unit", "line").limit(shown).collect()
        raise IntakeError(ORCHESTRATION_CHILD_FAILURE,
                          f"{n['n_failed']} of {n['n_units']} units failed: "
                          + "; ".join(r["line"] for r in lines))


MOVE_SCHEMA = "path string, status string, moved_to string, move_error string"
INTENT_SCHEMA = "path string, status string, target string, length long, modified long"


def _intents(processed: str, error: str):
    """Where each file of the outcomes goes, and the version that is to go there."""
    def run(batches):
        for b in batches:
            rows = []
            for path, status in zip(*(b.column(i).to_pylist() for i in range(2))):
                folder = processed if status == PROCESSED else error
                length, modified = task_version(path) or (None, None)
                rows.append((path, status, f"{folder.rstrip('/')}/{path.rsplit('/', 1)[-1]}",
                             length, modified))
            yield _batch(rows, INTENT_SCHEMA)
    return run


def _moves(batches):
    for b in batches:
        rows = []
        for path, status, target, length, modified in zip(*(c.to_pylist() for c in b.columns)):
            try:
                now = task_version(path)
                if length is None:
                    raise FileNotFoundError(path)
                if now == (length, modified):
                    if path != target:
                        task_move(path, target)
                elif (task_version(target) or (None,))[0] != length:
                    # not there, and not moved by an earlier attempt either
                    raise FileNotFoundError(path if now is None else f"{path} has changed")
                rows.append((path, status, target, None))
            except Exception as exc:  # noqa: BLE001 - reported as data
                rows.append((path, status if status == PROCESSED else CASCADING_FAILURE, None,
                             f"{type(exc).__name__}: {exc}"))
        yield _batch(rows, MOVE_SCHEMA)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
        [name for name, _ in fields])


def move_by_outcome(spark: SparkSession, dispositions: DataFrame, processed: str,
                    error: str, partitions: int | None = None) -> DataFrame:
    """Move every present input to ``processed`` or ``error`` by its status.

    Tasks rename the files. First the intent of every move – where the file goes and its length
    and modification time – is written to the shared folder; then the moves are made from
    there and their results written, so nothing is moved by reading the result. A task that is
    run again finds a file that it moved before by its target and moves nothing twice; a file
    of another version that was sent meanwhile is not touched. Returns ``(path, status,
    moved_to, move_error)``; a failed move of a failed file has the status
    ``cascading_failure``, as when quarantine fails after a pipeline error.

    Paths in a store that tasks cannot reach (``files.TASK_SCHEMES``) are renamed by the driver.
    """
    rows = dispositions.filter(F.col("status") != MISSING_FILE).select("path", "status")
    folders = {scheme_of(f) for f in (processed, error)}
    scheme = F.lower(F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    reach = scheme.isin("", *TASK_SCHEMES) if folders <= set(TASK_SCHEMES) else F.lit(False)
    n = partitions or spark.sparkContext.defaultParallelism
    plan = _written(rows.filter(reach).repartition(n, "path").mapInArrow(
        _intents(processed, error), INTENT_SCHEMA), "move-intents")
    done = _written(plan.mapInArrow(_moves, MOVE_SCHEMA), "moves")
    rest = _moved_by_driver(spark, rows.filter(~reach), processed, error)
    return done if rest is None else done.unionByName(rest)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _moved_by_driver(spark: SparkSession, rows: DataFrame, processed: str,
                     error: str) -> DataFrame | None:
    def move(row):
        path, status = row
        try:
            return path, status, move_to(spark, path,
                                         processed if status == PROCESSED else error), None
        except Exception as exc:  # noqa: BLE001 - reported as data
            failed = status if status == PROCESSED else CASCADING_FAILURE
            return path, failed, None, f"{type(exc).__name__}: {exc}"

    pairs = [(r["path"], r["status"]) for r in rows.toLocalIterator()]
    if not pairs:
        return None
    with ThreadPoolExecutor(max_workers=16) as pool:
        return spark.createDataFrame(list(pool.map(move, pairs)), MOVE_SCHEMA)
