"""Ledger of processed items: anti join, first-write-wins view, retention,
multi-run dedup with a publication gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.sources.tables import materialize


def new_items(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Items whose hash is not in the ledger (J1, U4). Duplicates inside the
    batch are kept, so this is a left anti join, not EXCEPT.

    Spark can only broadcast the right side of an anti join, and the ledger
    grows without bound. So the ledger is first semi-joined to the batch's
    distinct hashes, and the anti join runs against that matched set, which
    is never larger than the batch. Adaptive execution measures the hash
    set at run time and broadcasts it when small (a daily run): the ledger
    scan is then filtered map-side and never shuffled. For a large backfill
    it plans a shuffle join instead. No hint is given either way.
    """
    keys = items.select("hash").distinct()
    seen = ledger.select("hash").join(keys, "hash", "left_semi")
    return items.join(seen, "hash", "left_anti")


def first_wins(marks: DataFrame) -> DataFrame:
    """Ledger view over an append-only log of marks (K1, U3): per hash, the
    first ``url`` and ``seen_at`` (INSERT OR IGNORE semantics)."""
    return marks.groupBy("hash").agg(
        F.min_by("url", F.struct("seen_at", "url")).alias("url"),
        F.min("seen_at").alias("seen_at"))


def purge(ledger: DataFrame, now, days: int = vocab.LEDGER_RETENTION_DAYS) -> DataFrame:
    """Ledger rows kept by retention: seen at or after ``now - days`` (K2)."""
    now_c = now if not isinstance(now, str) else F.lit(now).cast("timestamp_ntz")
    return ledger.filter(F.col("seen_at") >= now_c - F.expr(f"interval {int(days)} days"))


def openings(marks: DataFrame, days: int = vocab.LEDGER_RETENTION_DAYS) -> DataFrame:
    """Rows that a ledger purged all along would have had (K1 with K2): per
    hash the first mark, then the first one more than ``days`` after it, and
    so on. A hash has at most one row per ``days`` of history, and a round
    settles one for every hash; so rounds follow the length of the history.
    """
    keep = F.expr(f"interval {int(days)} days")
    rest = materialize(marks.select("hash", "url", "seen_at").filter("hash is not null and seen_at is not null"), "open-marks")
    found = None
    while not rest.isEmpty():
        rows = materialize(first_wins(rest), "open-rows")
        found = rows if found is None else found.unionByName(rows)
        ends = rows.select("hash", (F.col("seen_at") + keep).alias("__end"))
        rest = materialize(rest.join(ends, "hash").filter(F.col("seen_at") > F.col("__end")).drop("__end"), "open-marks")
    return rest if found is None else found


def new_per_run(pairs: DataFrame, prior_ledger: DataFrame, run_status: DataFrame | None = None
                ) -> DataFrame:
    """Multi-run dedup in closed form.

    ``pairs`` are (run_ts, item) pairs from the recency join. An item is new
    at a run iff it is not in the prior ledger and no earlier successful run
    saw it: ``run_ts <= first_ok`` where ``first_ok`` is the first successful
    run of its hash. Failed runs mark nothing, so their items stay new. A run
    that ``run_status`` does not list has not published, here as in
    ``gated_marks``.
    """
    # by hash first, in narrow rows; the items themselves are shuffled once
    if run_status is not None:
        # a row for each run: written, so that the planner knows that they are few
        pairs = pairs.join(materialize(run_status.select("run_ts", "ok"), "run-status"), "run_ts", "left")
        ok = F.coalesce(F.col("ok"), F.lit(False))
    else:
        ok = F.lit(True)
    hashes = pairs.groupBy("hash").agg(F.min(F.when(ok, F.col("run_ts"))).alias("__first_ok"))
    fresh = new_items(hashes.filter("hash is not null"), prior_ledger).withColumn("__fresh", F.lit(True))
    # an item without a hash is in no ledger and no run marks it
    out = pairs.join(fresh, "hash", "left").filter(
        (F.col("hash").isNull() | F.col("__fresh"))
        & (F.col("__first_ok").isNull() | (F.col("run_ts") <= F.col("__first_ok"))))
    return out.drop("__first_ok", "__fresh")


def gated_marks(new_pairs: DataFrame, run_status: DataFrame) -> DataFrame:
    """Ledger rows written by the runs that published (K6): a failed run
    writes neither marks nor verdicts."""
    ok_runs = materialize(run_status.filter(F.col("ok")).select("run_ts"), "ok-runs")  # few, as the planner then knows
    return (new_pairs.join(ok_runs, "run_ts", "left_semi")
            .select("run_ts", "hash", F.col("link").alias("url"))
            .distinct())


def in_batch_collapse(items: DataFrame, group: str = "run_ts", order: str = "entry_pos"
                      ) -> DataFrame:
    """Optional: keep one item per hash inside a run (the original keeps both)."""
    from feedlake.operators.ranking import top_k
    return top_k(items, [group, "hash"], [F.col(order).desc()], 1, out="__r").drop("__r")
