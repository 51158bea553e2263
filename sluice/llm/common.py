"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Word separators of the contracts: U+0020 and U+0009 to U+000D.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: its lineage is cut,
    it survives lost executors, and several readers share one computation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def id_fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """True where the id's fold is ``fold``; a null id is never held out."""
    return F.coalesce(id_fold(key, folds) == fold, F.lit(False))


def slices(batches, column: int, limit: int = 4 << 20):
    """Arrow batches cut so that ``column`` holds about ``limit`` bytes in each (one row at
    least): bounds a Python worker's memory whatever the text lengths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = batch.column(column).nbytes
        if total <= limit or batch.num_rows == 1:
            yield batch
            continue
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        start = used = 0
        for i, n in enumerate(sizes):
            n = 0 if n != n else int(n)
            if i > start and used + n > limit:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += n
        yield batch.slice(start)
