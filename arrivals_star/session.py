"""Session set-up and the shared scratch folder used for tables written and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "arrivals_star", local_driver_memory: str = "16g") -> SparkSession:
    """Return the active session, or build one with settings suited to this job.

    On a cluster the caller normally owns the session; this helper is for tests, the bench and
    local runs. AQE re-plans joins and coalesces small shuffle partitions at run time, and its
    skew-join split handles a hot key on the shuffle-join fallback paths. In local mode every
    task runs in the driver JVM, whose heap defaults to 1 GB; ``local_driver_memory`` sizes it
    (it takes effect only when this call starts the JVM).
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               # A driver that runs many different plans evicts the default 100 compiled
               # stage classes and recompiles them on every run.
               .config("spark.sql.codegen.cache.maxEntries", "1000"))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", local_driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def case_sensitive_session(spark: SparkSession) -> SparkSession:
    """A session on the same context with the settings of ``spark``, in which column names that differ
    in case alone are different.

    Its frames may be written with such names, which the default setting refuses; Spark reads these
    files with ``spark.sql.caseSensitive`` only. The settings of ``spark`` itself stay as they are;
    temporary views are not shared.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own (as in tests); a cluster
    session without it is an error, since a machine-local folder is not visible to executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="arrivals-star-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root, unique per call, for a table written and read back.

    Frames that read the folder are lazy, so it stays while the session runs; the driver deletes
    it when it ends (or earlier through ``drop_scratch``).
    """
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    folder, fs = _folder(spark, path)
    fs.deleteOnExit(folder)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that no frame reads any more."""
    for path in paths:
        folder, fs = _folder(spark, path)
        fs.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


__all__ = ["get_session", "case_sensitive_session", "checkpoint_root", "scratch_path", "drop_scratch"]
