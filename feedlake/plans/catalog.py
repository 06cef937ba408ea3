"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle per key. Every query reads the driver tables at ``sf_dir`` whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.plans.oracle_views import with_views
from feedlake.session import ensure_utc
from feedlake.sources import fixtures as fx
from feedlake.operators import select as sel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


# ---------------------------------------------------------------- selection
@register("daily_top", with_views("""
select run_ts, cast(rank as int) as rank, entry_id, hash, severity, score, category
from (select *, row_number() over (partition by run_ts order by severity_rank, score desc, response_pos) as rank
      from v_daily where kept and severity in ('critical', 'important')) t
where rank <= 3
""", "v_daily"))
def q_daily_top(spark, base):
    """First three kept critical/important verdicts per run."""
    v = fx.daily_verdicts(spark, base)
    return sel.daily_top(v).select("run_ts", F.col("rank").cast("int"), "entry_id", "hash",
                                   "severity", "score", "category")


def _load_all() -> None:
    from feedlake.plans import q_scalar, q_daily, q_weekly, q_feeds, q_stream  # noqa: F401


_load_all()
