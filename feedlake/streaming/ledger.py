"""The ledger as a stream with retention.

Marks (hash, url, seen_at) arrive in any order within the lateness that the
watermark allows. Per hash the state holds the marks that open a ledger row:
the first one, and after it the first that comes more than the retention later
(by then the purge has removed the row, so the item is new again). A row leaves
the state once the watermark is past its retention, so state is bounded by the
hashes of the last ``retention`` and not by the stream's age.

A late mark may come before one that is held and move the row it opens, so
marks that open none are kept as long as that can matter: only those further
ahead of the watermark than the retention. Behind that point the row that
covers a mark can't move past it.

A call into Python, its state and its timer cost the same for one hash as for
many, so the state is kept by buckets of hashes: a value holds the marks of all
hashes of its bucket. A micro-batch reads and writes the buckets that it touches
or that a timer is due in. ``buckets`` goes with the hashes that the retention
holds, so that a bucket has some thousands; it is fixed by a query's first start,
as its state's parts are.

Each change of a hash's rows is written as a snapshot of them; a micro-batch
that is written again replaces its own folder. ``ledger_rows`` reads the last
snapshot of each hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlake import vocab
from feedlake.operators.ranking import top_k
from feedlake.streaming import stream as ST

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The marks of a bucket, in order, one entry each.
STATE = "hash array<string>, seen array<bigint>, url array<string>, timer bigint"
#: Buckets of a state that names none.
BUCKETS = 1024
SNAPSHOT = "hash string, seen array<bigint>, url array<string>"
DAY_US = 86_400_000_000

Mark = tuple[int, str]


def opening(marks: list[Mark], retention: int) -> list[Mark]:
    """Of sorted marks those that open a row: the first, then the first later than ``retention`` after it."""
    out: list[Mark] = []
    for m in marks:
        if not out or m[0] > out[-1][0] + retention:
            out.append(m)
    return out


def still_needed(marks: list[Mark], retention: int, watermark: int) -> list[Mark]:
    """The marks to hold once no mark at or before ``watermark`` can come any more."""
    opens = set(opening(marks, retention))
    return [m for m in marks
            if (m in opens and m[0] + retention >= watermark) or (m not in opens and m[0] > watermark + retention)]


class LedgerProcessor(StatefulProcessor):
    """Rows of the hashes of one bucket; times are microseconds, timers milliseconds."""

    def __init__(self, retention_us: int) -> None:
        self.retention = retention_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marks = handle.getValueState("marks", STATE)

    def _held(self) -> tuple[dict[str, list[Mark]], int | None]:
        state = self.marks.get()
        if state is None:
            return {}, None
        held: dict[str, list[Mark]] = {}
        for h, s, u in zip(*state[:3], strict=True):
            held.setdefault(h, []).append((s, u))
        return held, state[3]

    def _renewed(self, before: dict[str, list[Mark]], timer: int | None, come: dict[str, list[Mark]],
                 watermark_ms: int) -> Iterator[pd.DataFrame]:
        """``come``: the marks of the hashes that got some, with those held before."""
        watermark, held, changed = watermark_ms * 1000, {}, []
        for h, marks in (before | come).items():
            if h in come or marks[0][0] + self.retention < watermark:
                kept = still_needed(marks, self.retention, watermark)
                rows = opening(kept, self.retention)
                if rows != opening(before.get(h, []), self.retention):
                    changed.append((h, [s for s, _ in rows], [u for _, u in rows]))
                marks = kept
            if marks:
                held[h] = marks
        wanted = (min(m[0][0] for m in held.values()) + self.retention) // 1000 + 1 if held else None
        if wanted != timer:
            if timer is not None and timer > watermark_ms:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if not held:
            self.marks.clear()
        elif held != before:
            flat = [(h, s, u) for h, marks in held.items() for s, u in marks]
            self.marks.update((*map(list, zip(*flat, strict=True)), wanted))
        if changed:
            yield pd.DataFrame(changed, columns=["hash", "seen", "url"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before, timer = self._held()
        first: dict[str, dict[int, str]] = {}
        for batch in rows:
            for h, s, u in zip(batch["hash"], batch["seen_us"].tolist(), batch["url"], strict=True):
                own = first.setdefault(h, dict(before.get(h, ())))
                own[s] = min(u, own.get(s, u))
        come = {h: sorted(own.items()) for h, own in first.items()}
        yield from self._renewed(before, timer, come, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before, timer = self._held()
        yield from self._renewed(before, timer, {}, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def ledger_snapshots(marks: DataFrame, days: int = vocab.LEDGER_RETENTION_DAYS, late: str = "1 day",
                     buckets: int = BUCKETS) -> DataFrame:
    """Snapshots of the rows of each hash whose rows change. ``marks``: streaming (hash, url, seen_at).

    ``late``: how far behind the latest mark one may arrive; later ones are dropped.
    """
    keyed = (marks.select("hash", F.coalesce("url", F.lit("")).alias("url"), F.col("seen_at").cast("timestamp").alias("seen_at"))
             .filter("hash is not null and seen_at is not null").withWatermark("seen_at", late)
             .withColumns({"seen_us": F.unix_micros("seen_at"), "bucket": F.pmod(F.xxhash64("hash"), F.lit(buckets))}))
    return keyed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LedgerProcessor(days * DAY_US), outputStructType=SNAPSHOT, outputMode="Update", timeMode="EventTime")


@contextmanager
def rocksdb(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """The state store that keeps state on disk, for the queries started within.

    ``partitions``: parts of the state, which a query keeps from its first start on.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_ledger(marks: DataFrame, days: int = vocab.LEDGER_RETENTION_DAYS, late: str = "1 day", path: str | None = None,
               partitions: int | None = None, buckets: int = BUCKETS) -> str:
    """Consume the marks there are (AvailableNow) and return the folder of snapshots, one subfolder per micro-batch."""
    with rocksdb(marks.sparkSession, partitions):
        return ST.run_to_table(ledger_snapshots(marks, days, late, buckets), "stream-ledger", output_mode="update", path=path,
                               batch_fn=lambda b, i, out: b.write.mode("overwrite").parquet(f"{out}/batch={i}"))


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """hash, url, seen_at of the last snapshots."""
    log = spark.read.option("basePath", path).schema(f"{SNAPSHOT}, batch bigint").parquet(path)
    last = top_k(log, ["hash"], [F.col("batch").desc()], 1, out="__r")
    rows = last.select("hash", F.explode(F.arrays_zip("seen", "url")).alias("m"))
    return rows.select("hash", F.col("m.url").alias("url"), F.timestamp_micros("m.seen").cast("timestamp_ntz").alias("seen_at"))
