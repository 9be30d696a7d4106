"""Session helpers: a local session for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cinemetrics") -> SparkSession:
    """Single-JVM session for tests and the local bench (no UI, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("CINEMETRICS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach; it is
    read from the session and used as is, and a cluster session without it is refused.
    Only a local session (tests) without it gets a fresh folder made here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors (HDFS or object storage)")
        conf_dir = tempfile.mkdtemp(prefix="cinemetrics-ckpt-", dir="/tmp")
        _delete_on_exit(spark, conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system of ``path`` remove the folder when the driver's JVM ends."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)


_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, in the session's one scratch folder.

    The folder lies in the shared checkpoint folder and is removed when the session's driver ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}"
        _delete_on_exit(spark, _SCRATCH[app])
    return f"{_SCRATCH[app]}/{name}-{uuid.uuid4().hex[:12]}"
