"""Daily and weekly selection: sort key, capped priority pick, residual,
fallbacks and optional quotas (all per run or per week, set-wise)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions.coerce import allow_category, severity_rank
from feedlake.operators.ranking import ordinal, top_k
from feedlake.sources.tables import materialize


def sort_key(tiebreak: list) -> list[Column]:
    """Severity rank ascending, score descending, then a stable tie-breaker.

    The original sorts are stable, so ties keep input order: response order
    in the daily job, publication order in the weekly one.
    """
    tb = [F.col(c) if isinstance(c, str) else c for c in tiebreak]
    return [severity_rank(F.col("severity")), F.col("score").desc(), *tb]


def with_sev_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("severity_rank", severity_rank(F.col("severity")))


def ranked(verdicts: DataFrame, group: str, tiebreak: list, out: str = "rank") -> DataFrame:
    """All kept verdicts with their 1-based position per group."""
    kept = verdicts.filter(F.col("kept"))
    return ordinal(kept, [group], sort_key(tiebreak), out=out)


def daily_top(verdicts: DataFrame, group: str = "run_ts", tiebreak=("response_pos",),
              cap: int = vocab.TOP_PRIORITY_CAP) -> DataFrame:
    """First ``cap`` kept verdicts of severity critical or important per run.

    Priority rows sort before all others, so the first ``cap`` priority rows
    are exactly the rows of rank <= cap that are priority.
    """
    prio = verdicts.filter(F.col("kept") & F.col("severity").isin(*vocab.PRIORITY_SEVERITIES))
    return top_k(prio, [group], sort_key(list(tiebreak)), cap, out="rank")


def daily_other(verdicts: DataFrame, group: str = "run_ts", tiebreak=("response_pos",),
                cap: int = vocab.TOP_PRIORITY_CAP, ident="response_pos") -> DataFrame:
    """Every other kept verdict, re-ranked from 1 in the same order.

    Overflow of the priority cap and kept ``ignore`` rows land here.
    """
    ident = [ident] if isinstance(ident, str) else list(ident)
    # at most ``cap`` rows a run: written, so that the planner knows it and leaves the verdicts where they are
    top = materialize(daily_top(verdicts, group, tiebreak, cap).select(group, *ident), "daily-top")
    rest = verdicts.filter(F.col("kept")).join(top, [group, *ident], "left_anti")
    return ordinal(rest, [group], sort_key(list(tiebreak)), out="rank")


def fallback_digest(items: DataFrame, group: str = "run_ts",
                    order=("source", "entry_pos"), n: int = vocab.FALLBACK_ITEMS) -> DataFrame:
    """Selection used when the scoring answer is unusable (W4): the first ``n``
    items in arrival order, all kept as ``notable`` with score 5 and the
    category of their source."""
    return fallback_verdicts(top_k(items, [group], list(order), n, out="rank"))


def fallback_verdicts(items: DataFrame) -> DataFrame:
    """Items as the fallback judges them."""
    return (items.withColumn("kept", F.lit(True))
            .withColumn("severity", F.lit(vocab.FALLBACK_SEVERITY))
            .withColumn("score", F.lit(vocab.FALLBACK_SCORE))
            .withColumn("category", allow_category(F.col("source_category")))
            .withColumn("reason", F.lit(vocab.FALLBACK_REASON)))


def fallback_recap_top(verdicts: DataFrame, group: str = "week",
                       tiebreak=("published_at", "hash"), n: int = vocab.RECAP_TOP) -> DataFrame:
    """Weekly highlights without a model answer: first ``n`` by the sort key."""
    return top_k(verdicts.filter(F.col("kept")), [group], sort_key(list(tiebreak)), n,
                 out="rank")


def quota_enforced(verdicts: DataFrame, group: str = "run_ts", tiebreak=("response_pos",),
                   per_severity: dict | None = None,
                   priority_cap: int = vocab.QUOTA_PRIORITY,
                   total_cap: int = vocab.QUOTA_TOTAL) -> DataFrame:
    """Selection quotas of the scoring rubric, enforced in code.

    At most 2 critical and 2 important, 3 of both together, 3 notable and
    6 in all per run, taken in sort order. Each cap is a top-k step, so the
    whole operator runs on partial window limits.
    """
    caps = per_severity or {"critical": vocab.QUOTA_PER_PRIORITY_SEVERITY,
                            "important": vocab.QUOTA_PER_PRIORITY_SEVERITY,
                            "notable": vocab.QUOTA_NOTABLE}
    key = sort_key(list(tiebreak))
    kept = verdicts.filter(F.col("kept"))
    parts = [top_k(kept.filter(F.col("severity") == sev), [group], key, k, out="__r").drop("__r")
             for sev, k in caps.items()]
    uncapped = kept.filter(~F.col("severity").isin(*caps.keys()))
    stage1 = reduce(DataFrame.unionByName, parts + [uncapped])
    is_prio = F.col("severity").isin(*vocab.PRIORITY_SEVERITIES)
    prio = top_k(stage1.filter(is_prio), [group], key, priority_cap, out="__r").drop("__r")
    stage2 = prio.unionByName(stage1.filter(~is_prio))
    return top_k(stage2, [group], key, total_cap, out="rank")
