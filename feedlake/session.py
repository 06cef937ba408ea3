"""Session helpers: UTC session, checkpoint folder taken from the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every feedlake job relies on. Time arithmetic assumes UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "feedlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with feedlake's required settings.

    Master and partition count are set only when given: on a cluster both
    come from ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All operators compute in UTC; the driver's own session may not say so."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: ``spark.checkpoint.dir``.

    A local session (one machine) that names none gets a folder of its own;
    on a cluster an unset folder is an error, since executors could not read
    what others wrote.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="feedlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for staged output; the name is
    unique across drivers that share the folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder of our own, through the session's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
