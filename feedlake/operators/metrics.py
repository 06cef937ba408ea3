"""Stage counters as a table (A7): one aggregate per stage, unioned."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_counts(stages: dict[str, DataFrame], group: str = "run_ts") -> DataFrame:
    """Rows (group, stage, n); each count is a partial aggregate per task."""
    parts = [df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
             .select(group, F.lit(name).alias("stage"), "n") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)

