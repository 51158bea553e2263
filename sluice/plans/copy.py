"""Table-to-table copy (C6): align → sanitise → length audit → backup → load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.align import align, missing_columns
from ..operators.clean import max_lengths, stringify, strip_zero_fraction
from ..sinks.tables import backup_csv, staged, truncate_load

# --- fixed value: the reference cleans this column name only; here it is the default ------
DEFAULT_RATE_COLUMNS = ("vatrate",)
# ----------------------------------------------------------------------------------------


@dataclass
class CopyResult:
    data: DataFrame          # aligned, all-string, sanitised rows
    lengths: DataFrame       # (column, max_len)
    missing: list[str]       # target columns absent from the source (NULL-filled)


def prepare_copy(source: DataFrame, target, rate_columns=DEFAULT_RATE_COLUMNS,
                 partitions: int | None = None) -> CopyResult:
    """Case-insensitive alignment, string cast + trim, zero-tail removal on rate columns.

    ``partitions`` spreads an under-partitioned source (e.g. a JDBC table read over one
    connection) over that many tasks first; worth it when later per-row work is heavy, not
    for casts alone.
    """
    missing = missing_columns(source, target)
    data = stringify(align(source.repartition(partitions) if partitions else source, target))
    present = [c for c in data.columns if c.lower() in {r.lower() for r in rate_columns}]
    if present:
        data = strip_zero_fraction(data, present)
    return CopyResult(data, max_lengths(data), missing)


def copy_table(source: DataFrame, target_table: str, rate_columns=DEFAULT_RATE_COLUMNS,
               backup_path: str | None = None, lengths: str = "observe",
               stage: bool = False) -> CopyResult:
    """Copy ``source`` into a catalog table; an empty source leaves the table as it is.

    ``lengths='observe'`` measures the longest value of every column during the load itself
    with an :class:`~pyspark.sql.Observation`, so the source is read once (once more for a
    backup); ``lengths='preflight'`` (the reference's order) measures them in one aggregation
    before anything is written. ``stage`` writes the prepared rows to the shared folder first, for
    the audit, backup and load – worth it for a modest database source, not for a very large
    one, which is simply read again. A missing backup folder skips only the backup (trap T11).
    """
    from contextlib import nullcontext

    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = source.sparkSession
    res = prepare_copy(source, spark.table(target_table).schema, rate_columns)
    with (staged(res.data) if stage else nullcontext(res.data)) as data:
        if lengths == "observe":
            obs = Observation("max_lengths")
            load = data.observe(obs, F.count(F.lit(1)).alias("rows"), *[
                F.max(F.length(F.col(f"`{c}`"))).cast("long").alias(f"_{i}")
                for i, c in enumerate(data.columns)])
            truncate_load(load, target_table, if_empty="keep")
            got = obs.get
            n, rows = got.get("rows") or 0, [(c, got.get(f"_{i}"))
                                             for i, c in enumerate(data.columns)]
        else:
            n = data.count()
            rows = [(r["column"], r["max_len"]) for r in max_lengths(data).collect()]
        if n == 0:
            return res
        if backup_path:
            backup_csv(data, backup_path)
        if lengths != "observe":
            truncate_load(data, target_table)
    res.lengths = spark.createDataFrame(rows, "column string, max_len long")
    return res
