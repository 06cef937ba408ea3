"""Write-ahead journal of the daily job's commit (K6).

What a job is going to publish and commit is written first, as an entry of its
own below the journal's folder: payloads, marks, rows for the store and the
publication outcomes known so far. Then the steps follow, each with an empty
marker file once it is done:

``prepared``   the entry is whole; from here on the job will be completed
``published``  payloads went out, their outcomes are in the entry
``merged``     the store's affected weeks are staged in the entry
``stored``     they have replaced those of the store
``marked``     the ledger has the marks

``recover`` goes through the entries that a killed job left and does the steps
that have no marker. Every step gives the same result when it is done again:
the staged payloads are published as they were, the staged weeks are put in
place again whatever the store holds by then, and marks count once, by the
first. An entry that is not ``prepared`` was never published and is dropped;
its items stay new.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import ledger as LG
from feedlake.session import delete_path
from feedlake.sources import store as ST

STEPS = ("prepared", "published", "merged", "stored", "marked")
Publish = Callable[[DataFrame], DataFrame | None]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_done(spark: SparkSession, entry: str, step: str) -> bool:
    fs, p = _fs(spark, f"{entry}/_{step}")
    return fs.exists(p)


def mark_done(spark: SparkSession, entry: str, step: str) -> None:
    fs, p = _fs(spark, f"{entry}/_{step}")
    fs.create(p, True).close()


def entries(spark: SparkSession, journal: str) -> list[str]:
    """The journal's entries, oldest first."""
    fs, p = _fs(spark, journal)
    if not fs.exists(p):
        return []
    return sorted(f"{journal}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory())


def prepare(spark: SparkSession, journal: str, payloads: DataFrame, items: DataFrame, rows: DataFrame,
            status: DataFrame) -> str:
    """Write an entry: ``items`` to mark, ``rows`` for the store, publication ``status`` as known."""
    entry = f"{journal.rstrip('/')}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    payloads.select("run_ts", "payload").write.parquet(f"{entry}/payloads")
    items.select("run_ts", "hash", "link").write.parquet(f"{entry}/items")
    ST._conform(rows, ST.STORE_SCHEMA).drop("week").write.parquet(f"{entry}/rows")
    status.select("run_ts", "ok").write.parquet(f"{entry}/status")
    mark_done(spark, entry, "prepared")
    return entry


def publish_entry(spark: SparkSession, entry: str, publish: Publish | None) -> None:
    """Publish an entry's payloads, unless that is done, and keep the outcome."""
    if is_done(spark, entry, "published"):
        return
    outcome = publish(spark.read.parquet(f"{entry}/payloads")) if publish is not None else None
    known = spark.read.parquet(f"{entry}/status") if outcome is None else outcome.select("run_ts", "ok")
    known.write.mode("overwrite").parquet(f"{entry}/outcome")
    mark_done(spark, entry, "published")


def drop(spark: SparkSession, entry: str) -> None:
    """Remove an entry; what a broken-off removal leaves counts as unprepared."""
    delete_path(spark, f"{entry}/_prepared")
    delete_path(spark, entry)


def complete(spark: SparkSession, entry: str, publish: Publish | None, ledger_path: str, store_path: str) -> None:
    """Do the steps of an entry that are not done yet, and remove it."""
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{entry}/{name}")

    publish_entry(spark, entry, publish)
    outcome = table("outcome")
    if not is_done(spark, entry, "merged"):
        kept = table("rows").join(outcome.filter("ok").select("run_ts"), "run_ts", "left_semi")
        ST.stage_upsert(spark, kept, store_path, f"{entry}/merged")
        mark_done(spark, entry, "merged")
    if not is_done(spark, entry, "stored"):
        ST.apply_upsert(spark, f"{entry}/merged", store_path)
        mark_done(spark, entry, "stored")
    if not is_done(spark, entry, "marked"):
        ST.append_ledger(LG.gated_marks(table("items"), outcome).withColumn("seen_at", F.col("run_ts")), ledger_path)
        mark_done(spark, entry, "marked")
    drop(spark, entry)


def recover(spark: SparkSession, journal: str, publish: Publish | None, ledger_path: str, store_path: str) -> int:
    """Complete what killed jobs left, oldest first; returns the number of jobs completed."""
    n = 0
    for entry in entries(spark, journal.rstrip("/")):
        if is_done(spark, entry, "prepared"):
            complete(spark, entry, publish, ledger_path, store_path)
            n += 1
        else:
            drop(spark, entry)
    return n
