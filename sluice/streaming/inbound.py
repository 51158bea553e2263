"""Incremental folder intake (S8): inbound files → the batch pipeline → replace by cycle.

The folder is listed (path, length, modification time; no contents) and the listing written
below the checkpoint, where a stream picks it up. Keyed streaming state holds the version
(length and modification time) of every path that was handed on, so a file is loaded when it
is new *or has changed*: a re-sent file of the same name replaces the rows of the old one, as
in the reference, and a listing that is read again changes nothing.

A listing file holds at most ``max_files_per_trigger`` paths and is one micro-batch, which hands
its file list to the batch functions; their rows replace the (cycle, file) partitions of the
sink, so a retried micro-batch is idempotent and files of one cycle arriving in different
micro-batches never remove each other's rows. With one file per cycle this equals the
reference's delete-cycle-then-append; ``key="billcycle"`` gives that rule literally. After the
write the batch's files move to the processed folder; a file that cannot be loaded moves to the
error folder alone (the reference's success / quarantine moves), or, without an error folder,
stops the stream, whose state then still has the old version.

The state is committed with the micro-batch and has at most as many partitions as a micro-batch
has paths: each partition costs a Python worker and a store commit in every micro-batch, with or
without a path. A stream keeps the number that it began with. A file that is there again
unchanged although it was loaded (its move was lost, or the same file was sent again with its
time) is only moved.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..errors import PIPELINE_FAILURE, IntakeError
from ..session import scratch_path
from ..sinks.cycles import commit_cycles
from ..sinks.tables import replace_partitions
from ..sources.files import move_to, qualify, split_existing

LISTING_SCHEMA = "path string, length long, modified long"     # milliseconds
VERSION_SCHEMA = "length long, modified long"
CHANGE_SCHEMA = "path string, changed boolean"
_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
_STATE_PARTITIONS_KEY = "spark.sql.shuffle.partitions"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FileVersions(StatefulProcessor):
    """State: the version of a path that was handed on last. A listed path is given out with
    whether its version is another one."""

    def init(self, handle) -> None:
        self.version = handle.getValueState("version", VERSION_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # a micro-batch may hold several listings of a path: the last version counts
        modified, length = max((r["modified"], r["length"]) for r in rows)
        known = self.version.get() if self.version.exists() else None
        changed = known is None or tuple(known) != (length, modified)
        if changed:
            self.version.update((length, modified))
        yield Row(path=key[0], changed=changed)

    def close(self) -> None:
        pass


def list_inbound(spark: SparkSession, inbound: str, listings: str, pattern: str = "*",
                 max_files: int = 100) -> int:
    """Writes the folder's present files as rows of ``listings``, at most ``max_files`` paths to
    a file; returns their number. Spark lists the folder and reads no content."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(inbound)
             .select("path", "length", F.unix_millis("modificationTime").alias("modified")))
    n = files.count()
    if n:
        (files.repartitionByRange(-(-n // max_files), "path").write.mode("append")
         .option("maxRecordsPerFile", max_files).parquet(listings))
    return n


def file_changes(spark: SparkSession, listings: str) -> DataFrame:
    """Stream of ``(path, changed)`` for the files of each listing, one listing file a
    micro-batch."""
    listed = (spark.readStream.schema(LISTING_SCHEMA).option("maxFilesPerTrigger", 1)
              .parquet(listings))
    return listed.groupBy("path").transformWithState(
        FileVersions(), CHANGE_SCHEMA, outputMode="Update", timeMode="None")


@contextmanager
def _stream_settings(spark: SparkSession, max_files: int) -> Iterator[None]:
    """Settings that a stream reads at its start: the store that this kind of keyed state needs
    and its number of partitions, not more than ``max_files``. They are put back afterwards;
    the stream keeps its own copy, the batch functions use the session's."""
    parts = min(int(spark.conf.get(_STATE_PARTITIONS_KEY)), max(1, max_files))
    settings = {_STORE_KEY: _STORE, _STATE_PARTITIONS_KEY: str(parts)}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stream_inbound(spark: SparkSession, inbound: str, sink: str, checkpoint: str,
                   to_rows: Callable[[SparkSession, list[str]], DataFrame],
                   processed: str | None = None, error: str | None = None,
                   key=("billcycle", "filename"),
                   pattern: str = "*", max_files_per_trigger: int = 100,
                   available_now: bool = True, every_seconds: float = 60,
                   versioned: bool = False) -> StreamingQuery:
    """Start the stream; ``to_rows(spark, paths)`` turns one batch of files into sink rows.

    With ``available_now`` the folder is listed once and the stream ends when that listing is
    worked off; otherwise it is listed again every ``every_seconds`` until the query is stopped.
    ``versioned`` commits each micro-batch to a versioned sink (:mod:`sluice.sinks.cycles`): a
    reader sees a cycle before or after it, never between; read it with ``read_cycles``.
    Listings stay in ``{checkpoint}-listing``; those of finished micro-batches may be removed.
    """
    listings = checkpoint.rstrip("/") + "-listing"
    per_file = "filename" in ([key] if isinstance(key, str) else key)

    def attempt(paths: list[str], folder: str) -> str | None:
        """Writes the rows of the paths; the reason if they could not be written."""
        try:
            (commit_cycles if versioned else replace_partitions)(
                to_rows(spark, paths), folder, key=key)
            return None
        except Exception as exc:  # noqa: BLE001 - reported per file
            return f"{type(exc).__name__}: {exc}"

    def load(paths: list[str]) -> dict[str, str]:
        """Writes the rows of the paths; the reason of each path that could not be loaded. If
        the batch fails as a whole, its files are tried one by one. Where a file would replace
        another one's rows the trials go to a scratch folder, then all good files are loaded
        together."""
        why = attempt(paths, sink)
        if why is None or len(paths) == 1:
            return {p: why for p in paths if why}
        tried = {p: attempt([p], sink if per_file else scratch_path(spark, "inbound-trial"))
                 for p in paths}
        good = [p for p in paths if not tried[p]]
        if good and not per_file and (why := attempt(good, sink)):
            tried.update(dict.fromkeys(good, why))
        return {p: reason for p, reason in tried.items() if reason}

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        # ≤ max_files_per_trigger rows; listings hold encoded URIs, the reads take paths
        rows = {qualify(spark, r["path"]): r["changed"] for r in batch.collect()}
        # A replayed micro-batch (driver lost after the moves, before the commit) finds
        # some files already moved: their rows were written before the move, so skip them.
        present = split_existing(spark, sorted(rows))[0] if rows else []
        paths = [p for p in present if rows[p]]
        bad = load(paths) if paths else {}
        if bad and not error:
            raise IntakeError(PIPELINE_FAILURE, bad[min(bad)], min(bad))
        for p in present:
            target = error if p in bad else processed
            if target:
                move_to(spark, p, target)

    def listed() -> int:
        return list_inbound(spark, inbound, listings, pattern, max_files_per_trigger)

    if not listed():
        # the stream needs its folder, also before the first file
        spark.createDataFrame([], LISTING_SCHEMA).write.mode("append").parquet(listings)
    with _stream_settings(spark, max_files_per_trigger):
        writer = (file_changes(spark, listings).writeStream.outputMode("update")
                  .foreachBatch(run_batch).option("checkpointLocation", checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime=f"{every_seconds} seconds")
        query = writer.start()
    if not available_now:
        def keep_listing():
            while not query.awaitTermination(every_seconds):
                listed()

        threading.Thread(target=keep_listing, name="inbound-listing", daemon=True).start()
    return query


def text_audit_rows(expected_columns: int, **options) -> Callable[[SparkSession, list[str]], DataFrame]:
    """Batch function for :func:`stream_inbound`: text intake → audit rows."""
    from ..operators.audit import audit_columns
    from ..plans.text import parse_text

    def to_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
        return audit_columns(parse_text(spark, paths, expected_columns, **options))

    return to_rows


def report_audit_rows(target_headers, kind: str = "csv", **options) -> Callable[[SparkSession, list[str]], DataFrame]:
    """Batch function for :func:`stream_inbound`: headed reports (``csv`` or ``xlsx``) →
    detected headers → clean rows → audit rows (C3 / C5)."""
    from ..operators.audit import audit_columns
    from ..plans.headed import ingest_csv, ingest_sheets

    def to_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
        if kind == "xlsx":
            res = ingest_sheets(spark, paths, target_headers, **options)
            broken = res.errors.first()
            if broken:   # the stream then tries the files one by one
                raise IntakeError(PIPELINE_FAILURE, broken["reason"], broken["_file"])
        else:
            res = ingest_csv(spark, paths, target_headers, **options)
        return audit_columns(res.data)

    return to_rows
