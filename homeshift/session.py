"""Spark session helpers.

On a cluster the session is created by the platform; ``ensure_checkpoint_dir``
only sets a checkpoint folder when the cluster did not name one (tests, local
runs), and never overrides ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


#: Scratch tables of this process, for ``clean_scratch``.
_SCRATCH: list[str] = []


def local_session(cores: str = "*", app: str = "homeshift", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only for a local master.

    Off ``local*`` the cluster must name the folder: a machine-local one would
    be written by every executor to its own disk.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="homeshift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables (scheme kept)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """Where the scratch tables of this process stand, for ``clean_scratch``."""
    return len(_SCRATCH)


def clean_scratch(spark: SparkSession, mark: int) -> None:
    """Delete the scratch tables made since ``mark``: at the end of a job, when all results are written elsewhere."""
    while len(_SCRATCH) > mark:
        drop_scratch(spark, _SCRATCH[-1])
        _SCRATCH.pop()


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` once as a parquet table in the shared checkpoint folder and read it back.

    One job (a reliable ``checkpoint()`` of an unpersisted plan computes it
    twice), and the lineage is cut: a lost executor replays from this table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("error")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a single file, asked of the path's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of this job that nothing reads any more (Hadoop file system call)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(base + "/"):
        raise ValueError(f"{path} is not under {base}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application).

    Functions of the package are pickled by reference, so every worker must be
    able to import it whatever the current folder of the driver is.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="homeshift-code-"), "homeshift.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if not f.endswith((".pyc", ".pyo")):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
