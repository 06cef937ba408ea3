"""Recency window, single run and many runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.sources.tables import materialize


#: Windows beyond this are expanded from items dealt out evenly.
DEALT_FROM_HOURS = 72


def recent(items: DataFrame, now, hours: int = vocab.RECENCY_HOURS) -> DataFrame:
    """Keep items with ``published_at >= now - hours``; inclusive, no upper bound (F1)."""
    now_c = now if not isinstance(now, str) else F.lit(now).cast("timestamp_ntz")
    return items.filter(F.col("published_at") >= now_c - F.expr(f"interval {int(hours)} hours"))


def items_per_run(items: DataFrame, runs: DataFrame, hours: int = vocab.RECENCY_HOURS,
                  fetched_col: str = "published_at") -> DataFrame:
    """Range join of runs to items, the multi-run form of the recency window.

    A run at ``run_ts`` sees an item iff ``fetched_at <= run_ts`` and
    ``published_at >= run_ts - hours`` (no upper bound on the publication
    date). Spark has no range-join operator, so each item is expanded to the
    calendar days from its arrival to the end of its window, as far as there
    are runs at all, and joined to the runs on the day: an equi-join with a
    residual predicate instead of a nested loop. A window of any length and
    an item dated any time ahead are expanded in full; an item's days outside
    the first and last run can pair with nothing and are left out.

    The runs are written first, so that the planner knows their size and can
    broadcast them: the expanded items are not shuffled by the day then, of
    which there are few. Items that a long window makes many rows of are dealt
    out evenly before, since a few tasks may read them all.
    """
    runs = materialize(runs, "runs")
    if hours > DEALT_FROM_HOURS:
        items = items.hint("rebalance")
    window = F.expr(f"interval {int(hours)} hours")
    first, last = (runs.agg(f("run_ts").cast("date")).scalar() for f in (F.min, F.max))
    expanded = (items.withColumns({
        "__lo": F.greatest(F.col(fetched_col).cast("date"), first),
        "__hi": F.least((F.col("published_at") + window).cast("date"), last)})
        .filter("__lo <= __hi")
        .withColumn("__day", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi"))
    r = runs.withColumn("__day", F.col("run_ts").cast("date"))
    pairs = expanded.join(r, "__day", "inner").filter(
        (F.col(fetched_col) <= F.col("run_ts"))
        & (F.col("published_at") >= F.col("run_ts") - window))
    return pairs.drop("__day")
