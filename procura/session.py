"""Session helpers.

Library functions never create a session; they take DataFrames.  These helpers
are for tests, tools and ``bench.py`` only, plus :func:`checkpoint_dir`, which
reads the shared checkpoint folder from the session and only sets a scratch
one when the cluster has none (local tests).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session used with this library should carry.
SQL_CONF = {
    # dates are derived from *_gmt timestamps: pin the zone (reference trap T6)
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce / split partitions inside persisted intermediates too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "procura", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**SQL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the library relies on (idempotent)."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a shared file system path and
    is used as is (unset on a cluster is an error).  Only in local mode with
    nothing set (tests) a scratch folder is created and registered.
    """
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                               "(a machine-local folder does not work on a cluster)")
        d = tempfile.mkdtemp(prefix="procura-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing = {"lock": threading.Lock(), "depth": 0, "before": "false"}


@contextmanager
def shuffles_released(spark: SparkSession):
    """Writes inside drop the shuffle files of their plan as soon as they are
    done, so the disk holds those of one step at a time and not of all steps
    before it.  Writes may run side by side."""
    with _releasing["lock"]:
        if not _releasing["depth"]:
            _releasing["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _releasing["depth"] += 1
    try:
        yield
    finally:
        with _releasing["lock"]:
            _releasing["depth"] -= 1
            if not _releasing["depth"]:
                spark.conf.set(SHUFFLE_CLEANUP, _releasing["before"])


def owned_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, deleted when the session
    ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/procura-{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def materialize(df, mode: str = "table"):
    """Compute ``df`` once for several consumers in the same job.

    * ``table``: write it as parquet under the shared checkpoint
      folder (``spark.checkpoint.dir``) and read it back.  Lineage is cut, a
      lost executor costs no recomputation of the upstream, and later readers
      get column pruning and predicate pushdown on the columnar files.
    * ``checkpoint``: Spark's reliable RDD checkpoint into the same folder.
    * ``persist``: executor memory / local disk, recomputed from lineage if an
      executor is lost.
    * ``none``: unchanged (one lazy plan; equal parts of it share exchanges).
    """
    if mode == "none":
        return df
    if mode == "persist":
        from pyspark import StorageLevel
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    spark = df.sparkSession
    if mode == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    if mode == "table":
        path = owned_folder(spark, "once")
        with shuffles_released(spark):
            df.write.parquet(path)
        return spark.read.parquet(path)
    raise ValueError(f"unknown materialize mode {mode!r}")
