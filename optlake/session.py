"""Session settings shared by library, tests and bench.

Everything here is a runtime SQL conf, so it can be applied to a session the
caller (or a cluster launcher) already built.  The shared scratch folder comes
from ``spark.checkpoint.dir``; we only set our own when it is unset (tests).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Runtime confs the operators rely on.  Session zone UTC: every trade date is
# the UTC date.  AQE re-plans joins from real shuffle sizes (that is our size
# check before broadcasting) and splits skewed join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle afterwards
    # (nearest-strike joins feed an aggregation keyed on the join keys)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# (dynamic partition overwrite is passed per write by the table store, not set
# for the whole session)

_LOCAL_SCRATCH = "/tmp/optlake-scratch"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs; set a checkpoint dir only if none is given."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ckpt = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not ckpt:
        if is_local(spark):
            spark.sparkContext.setCheckpointDir(_LOCAL_SCRATCH + "/checkpoints")
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(ckpt)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM on one machine, where a machine-local folder is shared by all tasks."""
    return spark.sparkContext.master.split("[")[0] == "local"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and staged writes.

    It is the cluster's ``spark.checkpoint.dir``.  Without one, a local master
    gets a folder of its own; any other master raises, since each executor would
    write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        prepare_session(spark)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/optlake/{label}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder (a finished scratch copy) through the Hadoop file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """A path as Python's file functions take it; None if it is not on the local (or a mounted) file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path (none if it does not exist)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(where) if st.isDirectory()] if fs.exists(where) else []


def get_session(master: str | None = None, app: str = "optlake", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session for tests and the bench; clusters bring their own."""
    master = master or os.environ.get("OPTLAKE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OPTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def materialize(df, label: str):
    """Write ``df`` once to a fresh Parquet folder under the shared scratch
    root and return a reader over it.

    Used where one intermediate feeds several branches of a plan: the
    branches then scan the written copy instead of recomputing it, and the
    lineage is cut (a lost executor does not force a recompute from source).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
