"""Running sums that stay exact and spread out when one group is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: sum of ``value`` over the rows before this one in its group.

    Rows are ordered by (bucket, order).  Each (group, bucket) is summed by
    itself; the buckets' totals, one row each, are summed over the group.  The
    caller makes buckets of bounded size.  Group columns must not be null.
    """
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__total"))
    totals = totals.select(*group, bucket, F.coalesce(F.sum("__total").over(outer), F.lit(0)).alias("__base"))
    return (df.withColumn("__local", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(totals, [*group, bucket])
            .withColumn(out, F.col("__base") + F.col("__local")).drop("__base", "__local"))
