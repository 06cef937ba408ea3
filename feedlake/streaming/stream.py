"""Structured Streaming forms of ingest, dedup, weekly counts and the daily
digest (T1-T4). A query keeps its output, state and progress below the ``path``
it is given, so that a restarted one goes on where it stopped; without a path
it runs once, in a fresh folder below the session's checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.session import delete_path, scratch_path
from feedlake.sources import store as ST


def file_stream(spark: SparkSession, directory: str, file_glob: str, fmt: str = "parquet",
                schema=None, max_files: int | None = None) -> DataFrame:
    """Landed files as a stream; a single file is selected by glob inside its
    directory (file streams do not accept a file path). ``seen_at`` is the
    time at which the row's file landed."""
    if schema is None:
        schema = spark.read.format(fmt).load(f"{directory.rstrip('/')}/{file_glob}").schema
    r = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory).withColumn("seen_at", F.col("_metadata.file_modification_time"))


def with_event_time(df: DataFrame, col: str = "published_at", out: str = "event_ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def dedup(df: DataFrame, key: str = "hash", ts: str = "seen_at",
          retention: str = f"{vocab.LEDGER_RETENTION_DAYS} days") -> DataFrame:
    """First sighting of each key within the retention horizon (T2): state is
    dropped once the watermark passes, like the ledger's 90-day purge. The
    watermark runs on the arrival time, which is what retention means: a
    publication date far ahead can't move it."""
    return df.withWatermark(ts, retention).dropDuplicatesWithinWatermark([key])


def week_counts(df: DataFrame, ts: str = "event_ts", late: str = "7 days") -> DataFrame:
    """Tumbling ISO-week windows (Monday 00:00 UTC): 7-day windows are
    aligned on the epoch, a Thursday, so a 4-day start offset gives Mondays (T3)."""
    w = F.window(ts, "7 days", "7 days", "4 days")
    return (df.withWatermark(ts, late).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("week_start"), "n"))


def run_to_table(df: DataFrame, name: str, output_mode: str = "append",
                 batch_fn: Callable | None = None, path: str | None = None) -> str:
    """Run a streaming query until its input is consumed (AvailableNow) and
    return the folder holding its output table.

    ``path``: folder that keeps the query's output and progress between calls.
    ``batch_fn(batch_df, batch_id, out_path)`` writes each micro-batch; it must
    give the same result when a batch is written again.
    """
    spark = df.sparkSession
    base = path.rstrip("/") if path else scratch_path(spark, name)
    out, ckpt = f"{base}/data", f"{base}/progress"
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if batch_fn is None and output_mode == "append":
        q = w.format("parquet").outputMode("append").start(out)
    else:
        fn = batch_fn or (lambda b, i, p: b.write.mode("overwrite").parquet(p))
        q = w.outputMode(output_mode).foreachBatch(lambda b, i: fn(b, i, out)).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def merge_by_run(select: Callable[[DataFrame], DataFrame], ident: tuple[str, ...] = ("entry_id",),
                 group: str = "run_ts") -> Callable:
    """foreachBatch writer for a selection per run (T4).

    A run's items may come in several micro-batches, so what an earlier batch
    chose for the runs that this batch touches is read back, selected again
    together with the batch, and those runs' partitions are replaced. That is
    exact for selections of the first k by an order: what one batch left out
    can't come back. Rows are told apart by ``ident``, so a batch written again
    changes nothing. ``select`` keeps the columns that it reads.
    """
    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("run_key", _run_key(group))
        merged = keyed
        if ST._exists(spark, out):
            stored = spark.read.parquet(out).withColumn("run_key", _run_key(group))
            touched = stored.join(keyed.select(group).distinct(), group, "left_semi")
            merged = keyed.unionByName(touched, allowMissingColumns=True)
        chosen = select(merged.dropDuplicates([group, *ident]))
        staging = scratch_path(spark, "stream-merge")
        chosen.withColumn("run_key", _run_key(group)).write.partitionBy("run_key").parquet(staging)
        staged = spark.read.parquet(staging).withColumn("run_key", _run_key(group))
        ST._overwrite_partitions(spark, staged, "run_key", out)
        delete_path(spark, staging)
    return write


def _run_key(group: str):
    return F.date_format(group, "'r'yyyyMMdd'T'HHmmssSSSSSS")


def fresh_rows(batch: DataFrame, ledger_log: DataFrame) -> DataFrame:
    """Rows of a batch that no earlier run has handled: not marked by an
    earlier run in the ledger, and of the batch's runs the first that has the
    hash. A run's own marks don't count, so a batch written again keeps its rows."""
    first = batch.groupBy("hash").agg(F.min("run_ts").alias("__first"))
    known = ledger_log.groupBy("hash").agg(F.min("seen_at").alias("__marked"))
    j = batch.join(first, "hash").join(known.join(first.select("hash"), "hash", "left_semi"), "hash", "left")
    return j.filter((F.col("run_ts") <= F.col("__first"))
                    & (F.col("__marked").isNull() | (F.col("__marked") >= F.col("run_ts")))).drop("__first", "__marked")


def daily_batch_writer(select: Callable[[DataFrame], DataFrame], ledger_path: str,
                       store_path: str, ident: tuple[str, ...] = ("entry_id",)) -> Callable:
    """foreachBatch writer for the daily job with its publish gate (T4, K6).

    Per micro-batch, in order: rows that an earlier run has handled are left
    out; the selection of the touched runs is published (``merge_by_run``); only
    then is the touched runs' selection upserted into the store, and last are
    the batch's marks appended to the ledger. A batch written again finds its own
    runs' marks, which don't count, and gives the same result.
    """
    merge = merge_by_run(select, ident)

    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        fresh = fresh_rows(batch, ST.read_ledger_log(spark, ledger_path))
        merge(fresh, batch_id, out)
        if not ST._exists(spark, out):
            return
        published = spark.read.parquet(out).drop("run_key").join(
            fresh.select("run_ts").distinct(), "run_ts", "left_semi")
        marks = fresh.select("hash", F.col("link").alias("url"), F.col("run_ts").alias("seen_at"))
        ST.upsert_store(spark, published.withColumn("recorded_at", F.col("run_ts")), store_path)
        ST.append_ledger(marks, ledger_path)
    return write
