"""Ranking primitives that stay exact when one group holds a third of the data.

``row_number() over (partition by g order by o)`` sorts a whole group inside
one task. ``ordinal`` instead range-partitions on ``(g, o)`` so a hot group is
spread over many tasks, numbers rows inside each range partition with
``monotonically_increasing_id`` (its high bits are the partition, its low bits
the row index, both in sort order), and adds per-(partition, group) offsets
computed on a small aggregate (one row per group per partition).

The numbered rows are written as Parquet to the session's checkpoint folder
before they are read twice: the ids depend on physical partitioning, which
adaptive execution could otherwise coalesce differently in the two branches;
read back they are fixed values. The offsets read their three columns only,
and what the caller does not select is not read again. The table also cuts
lineage, so a lost executor does not send the job back to the source scan.

Top-k per group (``row_number() <= k``) does not need this: Spark plans a
partial WindowGroupLimit before the shuffle, so each task forwards at most
k rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import scratch_path
from feedlake.sources.tables import materialize

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1
# The offsets table has one row per (range partition, group). It is written, so
# that the planner knows its size before it shuffles the numbered rows: it is
# broadcast under spark.sql.autoBroadcastJoinThreshold, else joined on (partition,
# group) with a shuffle, which is skew-free since a hot group spans many partitions.


def _sort_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def ordinal(df: DataFrame, group_cols: list[str], order_cols: list, out: str = "pos",
            num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number within ``group_cols`` by ``order_cols``.

    ``order_cols`` should form a total order inside a group (end with a unique
    key); ties otherwise get distinct but arbitrary numbers, like row_number.
    """
    keys = _sort_cols(group_cols) + _sort_cols(order_cols)
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__part", F.shiftright(F.col("__mid"), _LOW_BITS))
              .withColumn("__idx", F.col("__mid").bitwiseAND(F.lit(_LOW_MASK)))
              .drop("__mid"))
    spark = df.sparkSession
    path = scratch_path(spark, "ordinal")
    tagged.write.parquet(path)
    tagged = spark.read.schema(tagged.schema).parquet(path)
    spans = (tagged.groupBy("__part", *group_cols)
             .agg(F.min("__idx").alias("__first"), F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(*group_cols).orderBy("__part")
    spans = spans.withColumn("__offset", F.sum("__n").over(w) - F.col("__n")).drop("__n")
    # null-safe on the group columns: a NULL group is one group, as in a window
    renamed = {c: f"__g{i}" for i, c in enumerate(group_cols)}
    spans = spans.select(F.col("__part").alias("__sp"),
                         *[F.col(c).alias(a) for c, a in renamed.items()], "__first", "__offset")
    spans = materialize(spans, "ordinal-spans")
    cond = [F.col("__part") == F.col("__sp")] + [F.col(c).eqNullSafe(F.col(a))
                                                 for c, a in renamed.items()]
    joined = tagged.join(spans, cond, "inner")
    return (joined.withColumn(out, F.col("__offset") + F.col("__idx") - F.col("__first") + 1)
            .drop("__part", "__idx", "__first", "__offset", "__sp", *renamed.values()))


def top_k(df: DataFrame, group_cols: list[str], order_cols: list, k: int,
          out: str = "rank") -> DataFrame:
    """First ``k`` rows per group with their 1-based rank.

    Planned as partial + final WindowGroupLimit: each task keeps k rows per
    group before the shuffle, so a hot group never reaches one task whole.
    """
    w = Window.partitionBy(*group_cols).orderBy(*_sort_cols(order_cols))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)
