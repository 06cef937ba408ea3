"""Weeks that close by themselves on a stream, and late items that open them again (T5).

The recap of an ISO week is due on its Sunday at 15:00. Kept verdicts flow in
by the time of the run that scored them. Per week the state holds what the
recap needs, the first verdicts by its order and the counts by category, and
an event-time timer at the due time lets it go. What a run scores after the
due time is late: it goes out as a row of its own at once.

State is kept by (week, part), a verdict's part being a hash of it, so that a
week of any size is PARTS tasks' work; the first verdicts of a week are among
the first of its parts, and counts add up.

The batch writer keeps both outputs as they come, one folder per micro-batch
(written again, a batch replaces its own). For each week that a batch closes,
or that gets late items once it is closed, it makes the recap anew from them
and replaces that week's partition: edition ``closed`` is what the recap said
when it was due, ``rebuilt`` what it says with the late items.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlake import vocab
from feedlake.functions import dates as D
from feedlake.functions.coerce import severity_rank
from feedlake.operators.ranking import top_k
from feedlake.session import delete_path, scratch_path
from feedlake.sources import store as STO
from feedlake.streaming import stream as ST
from feedlake.streaming.ledger import rocksdb

PARTS = 16
DUE = "6 days 15 hours"
#: Order of the weekly recap: severity, score (best first), then publication.
ORDER = ["severity_rank", "neg_score", "published_us", "hash", "entry_id"]
ROW = "severity_rank int, neg_score int, published_us bigint, hash string, entry_id bigint, category string"
STATE = f"top array<struct<{', '.join(c.replace(' ', ':') for c in ROW.split(', '))}>>, counts map<string, bigint>"
OUT = f"kind string, week string, due_us bigint, n bigint, {ROW}"
FIELDS = [c.split()[0] for c in ROW.split(", ")]
COLUMNS = ["kind", "week", "due_us", "n", *FIELDS]


class WeekProcessor(StatefulProcessor):
    """One part of a week: its first verdicts and counts until it is due, then late rows only."""

    def __init__(self, n_top: int) -> None:
        self.n_top = n_top

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.open.get()
        top, counts = ([tuple(t) for t in state[0]], dict(state[1])) if state is not None else ([], {})
        due = None
        for batch in rows:
            in_time = batch[batch["run_us"] <= batch["due_us"]]
            late = batch[batch["run_us"] > batch["due_us"]]
            if len(late):
                yield late.assign(kind="late", n=1)[COLUMNS]
            if len(in_time):
                due = int(in_time["due_us"].iloc[0])
                first = in_time.sort_values(ORDER).head(self.n_top)
                top = sorted(top + [tuple(r) for r in first[FIELDS].itertuples(index=False)],
                             key=lambda t: t[:5])[:self.n_top]
                for category, n in in_time.groupby("category").size().items():
                    counts[category] = counts.get(category, 0) + int(n)
        if due is not None:
            self.open.update((top, counts))
            if state is None:
                self.handle.registerTimer(due // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.open.get()
        if state is None:
            return
        due = expiredTimerInfo.getExpiryTimeInMs() * 1000
        # one row for each count, one for each of the first verdicts
        rows = [("count", key[0], due, n, *[None] * 5, category) for category, n in state[1].items()]
        rows += [("top", key[0], due, 0, *t) for t in state[0]]
        self.open.clear()
        yield pd.DataFrame(rows, columns=COLUMNS).astype(
            {"severity_rank": "Int32", "neg_score": "Int32", "published_us": "Int64", "entry_id": "Int64"})

    def close(self) -> None:
        pass


def week_events(verdicts: DataFrame, late: str = "0 seconds", n_top: int = vocab.RECAP_TOP) -> DataFrame:
    """Closings and late rows of streaming kept ``verdicts`` (run_ts, published_at, hash, entry_id, severity, score,
    category). ``late``: how far behind the latest run one may arrive and still count as of its time."""
    due = D.week_start("published_at") + F.expr(f"interval {DUE}")
    rows = verdicts.select(
        D.week_label("published_at").alias("week"), F.pmod(F.xxhash64("hash", "entry_id"), F.lit(PARTS)).alias("part"),
        F.col("run_ts").cast("timestamp").alias("run_at"), F.unix_micros(F.col("run_ts").cast("timestamp")).alias("run_us"),
        F.unix_micros(due.cast("timestamp")).alias("due_us"), severity_rank(F.col("severity")).alias("severity_rank"),
        (-F.col("score")).cast("int").alias("neg_score"), F.unix_micros(F.col("published_at").cast("timestamp")).alias("published_us"),
        "hash", F.col("entry_id").cast("bigint").alias("entry_id"), "category").withWatermark("run_at", late)
    return rows.groupBy("week", "part").transformWithStateInPandas(
        statefulProcessor=WeekProcessor(n_top), outputStructType=OUT, outputMode="Update", timeMode="EventTime")


def recaps(events: DataFrame, n_top: int = vocab.RECAP_TOP) -> DataFrame:
    """week, edition, n_kept, n_late, counts (by category), top (entry ids in order) of the closed weeks among ``events``."""
    closed = events.filter("kind <> 'late'")
    late = events.filter("kind = 'late'").join(closed.select("week").distinct(), "week", "left_semi")
    editions = closed.withColumn("edition", F.lit("closed")).unionByName(
        closed.unionByName(late).join(late.select("week").distinct(), "week", "left_semi").withColumn("edition", F.lit("rebuilt")))
    counts = (editions.filter("kind <> 'top'").groupBy("week", "edition", "category")
              .agg(F.sum("n").alias("n"), F.count_if(F.col("kind") == "late").alias("n_late"))
              .groupBy("week", "edition").agg(
                  F.sum("n").alias("n_kept"), F.sum("n_late").alias("n_late"),
                  F.array_sort(F.collect_list(F.struct("category", "n"))).alias("counts")))
    first = top_k(editions.filter("kind <> 'count'"), ["week", "edition"], [F.col(c) for c in ORDER], n_top, out="rank")
    top = first.groupBy("week", "edition").agg(F.array_sort(F.collect_list(F.struct("rank", "entry_id"))).alias("top"))
    return counts.join(top, ["week", "edition"], "left").select(
        "week", "edition", "n_kept", "n_late",
        F.array_join(F.transform("counts", lambda c: F.concat_ws(":", c["category"], c["n"].cast("string"))), ",").alias("counts"),
        F.array_join(F.transform("top", lambda t: t["entry_id"].cast("string")), ",").alias("top"))


def recap_writer(n_top: int = vocab.RECAP_TOP):
    """foreachBatch writer: the events of each batch, and the recaps of the weeks that it touches."""
    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").partitionBy("week").parquet(f"{out}/events/batch={batch_id}")
        touched = read_events(spark, out).filter(F.col("batch") == batch_id).select("week").distinct()
        if touched.isEmpty():
            return
        events = read_events(spark, out).filter(F.col("batch") <= batch_id).join(touched, "week", "left_semi")
        staging = scratch_path(spark, "week-recaps")
        recaps(events, n_top).write.parquet(staging)
        staged = spark.read.parquet(staging)
        if not staged.isEmpty():
            STO._overwrite_partitions(spark, staged, "week", f"{out}/recaps")
        delete_path(spark, staging)
    return write


def read_events(spark: SparkSession, out: str) -> DataFrame:
    """Closings and late rows so far; partitioned by batch and week."""
    return spark.read.option("basePath", f"{out}/events").schema(f"{OUT}, batch bigint").parquet(f"{out}/events")


def run_weeks(verdicts: DataFrame, late: str = "0 seconds", path: str | None = None, n_top: int = vocab.RECAP_TOP,
              partitions: int | None = None) -> str:
    """Consume the verdicts there are (AvailableNow); returns the folder of ``events`` and ``recaps``."""
    with rocksdb(verdicts.sparkSession, partitions):
        return ST.run_to_table(week_events(verdicts, late, n_top), "stream-weeks-close", output_mode="update",
                               batch_fn=recap_writer(n_top), path=path)


def read_recaps(spark: SparkSession, out: str) -> DataFrame:
    """The recaps of all closed weeks, in their editions."""
    schema = "edition string, n_kept bigint, n_late bigint, counts string, top string, week string"
    return STO.read_table(spark, f"{out}/recaps", spark.createDataFrame([], schema).schema)
