"""Intermediate tables in the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a local session that names none gets a folder of its own; on a
    cluster an unset folder is an error, since executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor does not replay what came before.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def posix_path(path: str) -> str:
    """Path of the shared folder as workers open it; it must be mounted on them."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"workers map model files into memory, which needs a mounted folder, not {path}")
    return path
