"""Session helpers: local test sessions and the shared scratch / checkpoint folder.

On a cluster the session is created by the caller and ``spark.checkpoint.dir`` names a
folder every executor can reach; the library only reads it. A private folder is created
only when the setting is missing *and* the master is local (tests, notebooks).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "sluice", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and the benchmark (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the setting is missing, a checkpoint folder set on the context is used; failing
    that, a private folder is created only if the master is local (tests, notebooks). A
    cluster without the setting is an error: machine-local folders are not shared.
    """
    global _local_root
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    sc = spark.sparkContext
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rsplit("/", 1)[0]
        elif _is_local(spark):
            _local_root = _local_root or tempfile.mkdtemp(prefix="sluice-ckpt-")
            root = _local_root
        else:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root (never a machine-local temp dir)."""
    return f"{shared_root(spark)}/sluice-scratch/{name}-{uuid.uuid4().hex[:12]}"
