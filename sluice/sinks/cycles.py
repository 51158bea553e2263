"""Replace by cycle with one commit (K3 / K6): versioned cycle folders and a commit log.

A load writes its rows to a folder of its own and the key values it replaces to another; nobody
reads either yet. One small file in the commit log then makes the load visible: version N is the
file ``N.json``, created only if no such file is there. A reader takes for every key value the
last committed load that has it. So

* a load that dies before its commit changes nothing: the old cycles stay whole;
* a reader sees a cycle either as it was or as the load has it, never a part of both;
* of two loads of one cycle the later commit stands, whole.

Folder layout below the root::

    data/load={id}/{key}={value}/...    rows, partitioned by load and key
    keys/load={id}/...                  the key values of a load
    _commits/{version}.json             load, keys and schema; its creation is the commit

Commits, keys and rows are read as DataFrames: only the last commit passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DATABASE_ERROR, MISSING_FILE, IntakeError
from ..functions.text import ident
from ..sources.files import create_new, delete, list_files

LOAD = "load"
COMMIT_SCHEMA = "load string, keys array<string>, schema string"


@dataclass(frozen=True)
class CycleLoad:
    """A written load that is not committed yet. ``base`` is the version it was written after."""
    root: str
    load: str
    keys: tuple[str, ...]
    schema: T.StructType
    base: int


def _log(root: str) -> str:
    return root.rstrip("/") + "/_commits"


def last_version(spark: SparkSession, root: str) -> int:
    """The last committed version; 0 before the first."""
    names = [p.rsplit("/", 1)[-1] for p in list_files(spark, _log(root), ".json")]
    return max((int(n.removesuffix(".json")) for n in names), default=0)


def _commits(spark: SparkSession, root: str, version: int) -> DataFrame:
    number = F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("long")
    log = spark.read.schema(COMMIT_SCHEMA).json(_log(root)).select("*", number.alias("version"))
    return log.filter(F.col("version") <= version)


def _key_rows(spark: SparkSession, root: str, fields) -> DataFrame:
    schema = T.StructType([*fields, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(schema).parquet(root.rstrip("/") + "/keys")


def stage_cycles(df: DataFrame, root: str, key="billcycle") -> CycleLoad:
    """Writes the rows and the key values they replace, without making them visible. ``df`` is
    computed once."""
    spark, root = df.sparkSession, root.rstrip("/")
    keys = (key,) if isinstance(key, str) else tuple(key)
    if LOAD in {c.lower() for c in df.columns}:
        raise IntakeError(DATABASE_ERROR, f"the column name {LOAD} is taken by the layout", root)
    base, load = last_version(spark, root), uuid.uuid4().hex
    name = f"{LOAD}=L{load}"
    df.write.partitionBy(*keys).parquet(f"{root}/data/{name}")
    fields = [df.schema[k] for k in keys]
    written = spark.read.schema(df.schema).parquet(f"{root}/data/{name}")
    written.select(*map(ident, keys)).distinct().write.parquet(f"{root}/keys/{name}")
    schema = T.StructType([f for f in df.schema.fields if f.name not in keys] + fields)
    return CycleLoad(root, "L" + load, keys, schema, base)


def commit(spark: SparkSession, staged: CycleLoad, on_conflict: str = "last") -> int:
    """Makes a staged load visible and returns its version.

    If other loads were committed since it was staged, ``on_conflict="last"`` commits after
    them (its cycles stand); ``"raise"`` does so only if they share no key value with it,
    otherwise it raises ``database_error`` and the load stays invisible.
    """
    text = json.dumps({"load": staged.load, "keys": list(staged.keys),
                       "schema": staged.schema.json()})
    seen = staged.base
    while True:
        last = last_version(spark, staged.root)
        if last > seen and on_conflict == "raise":
            rows = _key_rows(spark, staged.root, [staged.schema[k] for k in staged.keys])
            since = _commits(spark, staged.root, last).filter(F.col("version") > seen)
            mine = rows.filter(F.col(LOAD) == staged.load).drop(LOAD)
            theirs = rows.join(since.select(LOAD), LOAD).drop(LOAD)
            both = mine.intersect(theirs).first()
            if both:
                raise IntakeError(DATABASE_ERROR, "another load replaced the same cycle: "
                                  f"{both.asDict()}", staged.root)
        seen = last
        if create_new(spark, f"{_log(staged.root)}/{last + 1:012d}.json", text):
            return last + 1


def commit_cycles(df: DataFrame, root: str, key="billcycle", on_conflict: str = "last") -> int:
    """Replaces the key values present in ``df``, all others stay; returns the new version."""
    return commit(df.sparkSession, stage_cycles(df, root, key), on_conflict)


def _last_commit(spark: SparkSession, root: str, version: int | None):
    version = last_version(spark, root) if version is None else version
    row = _commits(spark, root, version).filter(F.col("version") == version).first() \
        if version else None
    if row is None:
        raise IntakeError(MISSING_FILE, "no committed load", root)
    return row, T.StructType.fromJson(json.loads(row["schema"]))


def live_loads(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Per key value the load (``load``) that a reader of the version sees."""
    row, schema = _last_commit(spark, root, version)
    keys = row["keys"]
    rows = _key_rows(spark, root, [schema[k] for k in keys])
    rows = rows.join(_commits(spark, root, row["version"]).select(LOAD, "version"), LOAD)
    return rows.groupBy(*map(ident, keys)).agg(F.max_by(LOAD, "version").alias(LOAD))


def read_cycles(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the last version (or of an earlier one), key columns last.

    Rows are picked by their partition columns, so only the folders of live loads are read.
    """
    row, schema = _last_commit(spark, root, version)
    live = live_loads(spark, root, row["version"])
    for k in row["keys"]:
        live = live.withColumnRenamed(k, f"_live_{k}")
    data = spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])) \
        .parquet(root.rstrip("/") + "/data")
    same = F.lit(True)
    for k in row["keys"]:
        same = same & ident(k).eqNullSafe(ident(f"_live_{k}"))
    live = live.withColumnRenamed(LOAD, "_live_load")
    return data.join(live, (F.col(LOAD) == F.col("_live_load")) & same, "left_semi").drop(LOAD)


def vacuum_cycles(spark: SparkSession, root: str, keep_versions: int = 1) -> list[str]:
    """Removes the folders of committed loads that neither the last version nor one of the
    ``keep_versions`` before it shows, and returns their ids. Loads that were staged and never
    committed are not touched: they may still be running."""
    last = last_version(spark, root)
    row, schema = _last_commit(spark, root, last)
    keys = [ident(k) for k in row["keys"]]
    rows = _key_rows(spark, root, [schema[k] for k in row["keys"]])
    commits = _commits(spark, root, last).select(LOAD, "version")
    later = Window.partitionBy(*keys).orderBy("version")
    ended = rows.join(commits, LOAD).withColumn("ended", F.lead("version").over(later))
    # a key value that no later load replaced keeps its load for good
    dead = ended.groupBy(LOAD).agg(F.max(F.coalesce("ended", F.lit(last + 1))).alias("ended")) \
        .filter(F.col("ended") <= last - keep_versions).select(LOAD)
    out = sorted(r[LOAD] for r in dead.collect())
    for load in out:
        for part in ("data", "keys"):
            delete(spark, f"{root.rstrip('/')}/{part}/{LOAD}={load}")
    return out
