"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfwise") -> SparkSession:
    """Local session for tests and the bench; on a cluster the caller's builder wins."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset (tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Connect session has no SparkContext; the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-")  # one machine: tests and the bench
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once per application), so that functions that run
    there import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_shelfwise_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shelfwise-code-"), "shelfwise.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._shelfwise_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, wherever Spark's file systems keep it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and continue from the written copy.

    Used for small derived tables (one row per book, per fold, per candidate) that several
    later jobs read: each is computed once, lineage is cut, and a lost executor re-reads the
    reliable copy instead of recomputing the chain."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """As :func:`materialize`, for large tables: a column file in the same folder, a fraction of a checkpoint's size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
