"""Parquet-backed tables: the ledger (append-only, first write wins on read)
and the verdict store (partitioned by week, last write wins by upsert).

There is no table format with MERGE here, so the upsert (C3) is: find the
affected weeks (the batch's weeks plus the stored weeks of the same hashes,
which a locator table beside the store knows, partitioned by hash prefix),
read those partitions, union with the batch, keep the latest row per hash,
write the result to a staging folder, then overwrite exactly those week
partitions from staging (dynamic partition overwrite). Reading and
overwriting one path in a single plan never happens.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from feedlake.functions.dates import week_label
from feedlake.operators import ledger as LG
from feedlake.operators.verdicts import upsert
from feedlake.session import delete_path, scratch_path

#: Files that one week of the store is written in at most; a busy week is so
#: dealt over several tasks.
FILES_PER_WEEK = 8

#: Hex digits of the locator's partitions: 256 of them.
PREFIX = 2

LEDGER_SCHEMA = Ty.StructType([
    Ty.StructField("hash", Ty.StringType(), False),
    Ty.StructField("url", Ty.StringType()),
    Ty.StructField("seen_at", Ty.TimestampNTZType()),
])

STORE_SCHEMA = Ty.StructType([
    Ty.StructField("hash", Ty.StringType(), False),
    Ty.StructField("run_ts", Ty.TimestampNTZType()),
    Ty.StructField("entry_id", Ty.LongType()),
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("translated_title", Ty.StringType()),
    Ty.StructField("summary", Ty.StringType()),
    Ty.StructField("link", Ty.StringType()),
    Ty.StructField("source", Ty.StringType()),
    Ty.StructField("source_category", Ty.StringType()),
    Ty.StructField("published_at", Ty.TimestampNTZType()),
    Ty.StructField("kept", Ty.BooleanType()),
    Ty.StructField("severity", Ty.StringType()),
    Ty.StructField("score", Ty.IntegerType()),
    Ty.StructField("reason", Ty.StringType()),
    Ty.StructField("category", Ty.StringType()),
    Ty.StructField("response_pos", Ty.LongType()),
    Ty.StructField("recorded_at", Ty.TimestampNTZType()),
    Ty.StructField("week", Ty.StringType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) if "*" in path else fs.exists(p)


def _conform(df: DataFrame, schema: Ty.StructType) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, schema: Ty.StructType) -> DataFrame:
    """A table, or an empty one of the declared schema if never written (K4)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------ ledger
_BUCKETS = "_buckets."  # a name that table scans pass over


def create_ledger(spark: SparkSession, path: str, buckets: int) -> None:
    """An empty ledger whose days are bucketed and sorted by hash.

    A batch that is large beside the ledger (a backfill) then joins with it
    bucket by bucket: the batch is shuffled, the ledger is not. Without this
    the first ``append_ledger`` makes a plain one.
    """
    if _exists(spark, path):
        raise ValueError(f"{path} exists")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{_BUCKETS}{int(buckets)}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, False).close()


def ledger_buckets(spark: SparkSession, path: str) -> int | None:
    """Number of buckets the ledger was created with, None for a plain one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{_BUCKETS}*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    return int(found[0].getPath().getName()[len(_BUCKETS):]) if len(found) else None


def _ledger_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The bucketed ledger as a table of the session's catalog; bucketing is known to tables only."""
    name = f"feedlake_ledger_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    spark.sql(f"drop table if exists {name}")  # an external table: its files stay
    spark.sql(f"""create table {name} (hash string, url string, seen_at timestamp_ntz, day date) using parquet
                  partitioned by (day) clustered by (hash) sorted by (hash) into {buckets} buckets
                  location '{path}'""")
    spark.sql(f"alter table {name} recover partitions")
    return name


def read_ledger_log(spark: SparkSession, path: str) -> DataFrame:
    """The raw marks; enough to test whether a hash is known, without the
    aggregation of the first-wins view."""
    buckets = ledger_buckets(spark, path)
    if buckets:
        return spark.table(_ledger_table(spark, path, buckets)).select(LEDGER_SCHEMA.names)
    return read_table(spark, path, LEDGER_SCHEMA)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """First-write-wins view of the append-only ledger (K1)."""
    return LG.first_wins(read_ledger_log(spark, path))


def append_ledger(marks: DataFrame, path: str) -> None:
    """Append marks (hash, url, seen_at). Duplicates are harmless: the read
    view keeps the first, which is INSERT OR IGNORE semantics."""
    rows = _conform(marks, LEDGER_SCHEMA).withColumn("day", F.col("seen_at").cast("date"))
    spark = marks.sparkSession
    buckets = ledger_buckets(spark, path)
    if buckets:  # one file for each bucket and day
        rows.repartition(buckets, "hash").write.insertInto(_ledger_table(spark, path, buckets))
    else:
        rows.write.mode("append").partitionBy("day").parquet(path)


def purge_ledger(spark: SparkSession, path: str, now, days: int = 90) -> int:
    """Drop the ledger's rows older than ``days`` (K2); returns the number of
    hashes removed.

    The log is partitioned by the day of the mark. Whole days before the
    cut-off are dropped as folders; the cut-off's own day is staged and
    overwritten (dynamic partition overwrite). Nothing else is rewritten, so
    a failure in between loses no mark that the retention keeps, and a second
    call goes on. A hash counts as removed when none of its marks is left.
    """
    if not _exists(spark, path):
        return 0
    buckets = ledger_buckets(spark, path)
    if buckets and not _exists(spark, f"{path}/day=*"):
        return 0
    log = spark.read.parquet(path)
    now_c = now if not isinstance(now, str) else F.lit(now).cast("timestamp_ntz")
    cut = spark.range(1).select((now_c - F.expr(f"interval {int(days)} days")).alias("c")).first().c
    old = log.filter(F.col("seen_at") < F.lit(cut))
    kept = log.filter(F.col("seen_at") >= F.lit(cut))
    removed = old.select("hash").distinct().join(kept, "hash", "left_anti").count()
    staging = scratch_path(spark, "ledger-purge")
    edge = F.col("day") == F.lit(cut.date())
    kept.filter(edge).write.parquet(staging)
    staged = spark.read.schema(log.schema).parquet(staging)
    if staged.isEmpty():
        delete_path(spark, f"{path}/day={cut.date()}")
    elif buckets:
        staged.createOrReplaceTempView(view := f"purged_{uuid.uuid4().hex}")
        spark.sql(f"""insert overwrite table {_ledger_table(spark, path, buckets)} partition (day = date '{cut.date()}')
                      select /*+ repartition({buckets}, hash) */ hash, url, seen_at from {view}""")
        spark.catalog.dropTempView(view)
    else:
        _overwrite_partitions(spark, staged, "day", path)
    days_gone = [r.day for r in log.filter(F.col("day") < F.lit(cut.date())).select("day").distinct().collect()]
    for day in days_gone:  # one folder for each day beyond retention
        delete_path(spark, f"{path}/day={day}")
    delete_path(spark, staging)
    return removed


def _overwrite_partitions(spark: SparkSession, df: DataFrame, column: str, path: str) -> None:
    """Replace the partitions that ``df`` has, and no others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


# ------------------------------------------------------------------ verdict store
def read_store(spark: SparkSession, path: str, weeks: list[str] | None = None) -> DataFrame:
    """The verdict store; a week list prunes partitions at the scan (an empty
    list selects no week, None all of them)."""
    s = read_table(spark, path, STORE_SCHEMA)
    if weeks is None:
        return s
    return s.filter(F.col("week").isin(*weeks)) if weeks else s.filter(F.lit(False))


def upsert_store(spark: SparkSession, batch: DataFrame, path: str) -> None:
    """Last write wins on hash (K3), rewriting only the affected weeks."""
    staging = scratch_path(spark, "store-staging")
    stage_upsert(spark, batch, path, staging)
    apply_upsert(spark, staging, path)
    delete_path(spark, staging)


def locator_path(path: str) -> str:
    return f"{path.rstrip('/')}.weeks"


def _prefix(hash_col: str = "hash"):
    """Locator partition of a hash: PREFIX hex digits, whatever form the hash has."""
    return F.left(F.md5(F.col(hash_col).cast("binary")), F.lit(PREFIX))


def _append_locator(rows: DataFrame, path: str, mode: str = "append") -> None:
    (rows.select("hash", "week").distinct().withColumn("prefix", _prefix()).repartition("prefix")
     .write.mode(mode).partitionBy("prefix").parquet(locator_path(path)))


def rebuild_locator(spark: SparkSession, path: str) -> None:
    """Write the locator anew from the store: after it was lost, or to drop weeks that hashes have left."""
    _append_locator(read_table(spark, path, STORE_SCHEMA), path, "overwrite")


def weeks_of(spark: SparkSession, hashes: DataFrame, path: str) -> DataFrame:
    """The weeks that hold (or held) ``hashes`` (hash): reads the locator's partitions of these hashes only."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "week string")
    if not _exists(spark, locator_path(path)):
        rebuild_locator(spark, path)
    own = hashes.select("hash").distinct()
    prefixes = [r[0] for r in own.select(_prefix().alias("p")).distinct().collect()]  # 16^PREFIX at most
    known = spark.read.schema("hash string, week string, prefix string").parquet(locator_path(path))
    return known.filter(F.col("prefix").isin(prefixes)).join(own, "hash", "left_semi").select("week").distinct()


def stage_upsert(spark: SparkSession, batch: DataFrame, path: str, staging: str) -> None:
    """The affected weeks as the upsert leaves them, below ``staging``; the store is only read.

    The locator learns where the batch's hashes will be before the store has
    them: an entry too many costs a week's reading, one too few would leave a
    second row of a hash behind.
    """
    b = _conform(batch.withColumn("week", week_label(F.col("published_at"))), STORE_SCHEMA)
    # weeks whose partitions change: the batch's, and where its hashes live now; as many as the calendar has
    b.select("week").union(weeks_of(spark, b, path)).distinct().write.mode("overwrite").parquet(f"{staging}/weeks")
    weeks = [r.week for r in spark.read.schema("week string").parquet(f"{staging}/weeks").collect()]
    affected = read_store(spark, path, weeks)
    merged = upsert(affected, b, key="hash", order=("recorded_at", "response_pos"))
    dealt = _conform(merged, STORE_SCHEMA).repartition("week", F.pmod(F.xxhash64("hash"), F.lit(FILES_PER_WEEK)))
    dealt.write.mode("overwrite").partitionBy("week").parquet(f"{staging}/rows")
    staged = spark.read.schema(STORE_SCHEMA).parquet(f"{staging}/rows")
    _append_locator(staged.join(b.select("hash").distinct(), "hash", "left_semi"), path)


def apply_upsert(spark: SparkSession, staging: str, path: str) -> None:
    """Replace the affected weeks by what ``stage_upsert`` left; it reads nothing of the
    store, so it can be done again after it broke off at any point."""
    staged = spark.read.schema(STORE_SCHEMA).parquet(f"{staging}/rows")
    weeks = spark.read.schema("week string").parquet(f"{staging}/weeks")
    # a week whose rows all moved away must still be rewritten (emptied)
    emptied = weeks.join(staged.select("week").distinct(), "week", "left_anti").collect()
    _overwrite_partitions(spark, staged.repartition("week", F.pmod(F.xxhash64("hash"), F.lit(FILES_PER_WEEK))),
                          "week", path)
    for r in emptied:
        delete_path(spark, f"{path}/week={r.week}")
