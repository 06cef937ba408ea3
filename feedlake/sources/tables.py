"""Readers for the landed tables (one parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table below the session's checkpoint folder
    and read it back: cuts lineage (a lost executor does not replay the
    upstream plan) and keeps later plans small."""
    from feedlake.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
