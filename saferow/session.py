"""Session and shared-folder helpers.

On a cluster the checkpoint folder is set by the operator through
``spark.checkpoint.dir`` (a shared, fault-tolerant file system).  We only read
it; a private folder is created solely when nothing is configured (local runs
and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "saferow") -> SparkSession:
    """Session for local runs and tests. Cluster jobs get theirs from spark-submit."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Driver and executors in one process, so a machine-local folder is shared."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the context);
    only when neither exists, a private one is made and registered, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="saferow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (its scheme is kept);
    the folder is deleted when the driver's JVM ends."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/saferow-scratch"
    if is_local(spark.sparkContext.master) and base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{base}/{name}-{uuid.uuid4().hex}"
