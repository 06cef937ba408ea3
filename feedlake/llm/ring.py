"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

DataFrame functions only.  Each shard has ``virtual`` points on the ring of
64-bit hashes; a document's point is the hash of its text, so that copies lie
side by side.  The arc that ends at a virtual node holds the points from the
node before it on.  A shard is full at ``cap`` bytes, (1 + ``slack``) of the
mean; keys of a full shard continue clockwise to the next one that is not.

1. Arcs.  The ring is cut into cells; documents find their arc by an equi-join
   on the cell and two comparisons.  A document's place in its arc is the sum
   of the bytes before it, summed by buckets of a range partitioning (a group
   of copies of any size is dealt over many).
2. Bounds.  Only the arcs' totals take part, one row for each virtual node.  In
   a round every arc offers its unplaced bytes to the next shard clockwise that
   is not full; a shard takes offers in ring order until it is.  A round with
   bytes left over fills a shard, so there are no more rounds than shards.
3. Documents go where the piece of the arc that their first byte falls in went.

A shard ends within cap and one document.  The points don't depend on the
number of shards, so a further shard moves the arcs it cuts out and what
overflows elsewhere (the tests measure that).  The law that holds is ``bytes``.

Edge cases: a null text has no bytes (size 1, crc32 0) and a point of its own;
empty texts likewise; documents of one text are ordered by a hash of doc_id,
then doc_id (null: first); repeated rows are rows of their own; a text longer
than a shard's share makes that shard exceed the mean by its length; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm.prefix import running_sum
from feedlake.llm.scratch import written

SHARDS = 8
VIRTUAL = 256
#: A shard may hold this much more than the mean, in thousandths.
SLACK = 2
#: Cells for each virtual node.
CELLS = 2
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Order of documents along the ring.
ALONG = ["arc", "turn", "point", "tie", "doc_id"]


def ring(spark: SparkSession, shards: int, virtual: int = VIRTUAL) -> DataFrame:
    """arc (0.. clockwise), shard, and the arc's points low..high; the first arc has two rows (``turn`` 0, 1)."""
    nodes = (spark.range(shards * virtual)
             .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("copy"))
             .select("shard", F.xxhash64(F.lit("node"), "shard", "copy").alias("high")))
    along = Window.orderBy("high", "shard")
    cut = nodes.select("shard", "high", (F.row_number().over(along) - 1).cast("int").alias("arc"),
                       F.lag("high").over(along).alias("before"), F.max("high").over(Window.partitionBy()).alias("last"))
    inner = cut.select("arc", "shard", F.lit(1).alias("turn"),
                       F.when(F.col("before").isNull(), F.lit(LEAST)).otherwise(F.col("before") + 1).alias("low"), "high")
    over = cut.filter(f"arc = 0 and last < {MOST}").select(
        "arc", "shard", F.lit(0).alias("turn"), (F.col("last") + 1).alias("low"), F.lit(MOST).alias("high"))
    return inner.unionByName(over).filter("low <= high")


def keys(docs: DataFrame, shards: int, virtual: int = VIRTUAL) -> DataFrame:
    """doc_id, size, text_crc32, arc, home (the arc's shard), and the order along the ring."""
    spark = docs.sparkSession
    shift = 64 - (CELLS * shards * virtual).bit_length()
    cells = ring(spark, shards, virtual).withColumn(
        "cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright("high", shift))))
    own = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("point"), F.xxhash64("doc_id").alias("tie")).withColumn("cell", F.shiftright("point", shift))
    # as many rows as the ring has cells and virtual nodes, whatever the documents
    return (own.join(F.broadcast(cells), "cell").filter("point between low and high")
            .select("doc_id", "size", "text_crc32", "arc", F.col("shard").alias("home"), "turn", "point", "tie"))


def pieces(arcs: DataFrame, shards: int, slack: int = SLACK) -> DataFrame:
    """arc, begin, end, shard: where each arc's bytes go.

    ``arcs``: one row for each arc: arc, home, bytes.
    """
    arcs = written(arcs, "ring-arcs")
    total = arcs.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    cap = -(-total * (1000 + slack) // (1000 * shards))
    state = arcs.select("arc", "home", "bytes", F.lit(0).cast("long").alias("begin"))
    done: list[DataFrame] = []
    ahead = Window.orderBy("arc").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    queue = Window.partitionBy("shard").orderBy("arc")
    while not done or not state.filter("begin < bytes").isEmpty():
        if done:
            loads = _all(done).groupBy("shard").agg(F.sum(F.col("end") - F.col("begin")).alias("load"))
        else:
            loads = arcs.select(F.col("home").alias("shard"), F.lit(0).cast("long").alias("load")).distinct()
        free = loads.select(F.col("shard").alias("home"), (F.lit(cap) - F.col("load")).alias("free"))
        # the next open shard clockwise, as (arc of the virtual node, shard, what it can take)
        seen = state.join(free, "home", "left").withColumn("free", F.coalesce("free", F.lit(cap)))
        node = F.when(F.col("free") > 0, F.struct("arc", F.col("home").alias("shard"), "free"))
        asked = F.coalesce(F.min(node).over(ahead), F.min(node).over(everything))
        offers = (seen.withColumn("asked", asked).filter("begin < bytes")
                  .select("arc", "begin", "bytes", F.col("asked.shard").alias("shard"), F.col("asked.free").alias("free"))
                  .withColumn("rest", F.col("bytes") - F.col("begin"))
                  .withColumn("before", F.sum("rest").over(queue) - F.col("rest")))
        took = F.least("rest", F.greatest(F.col("free") - F.col("before"), F.lit(0).cast("long")))
        done.append(written(offers.select("arc", "begin", (F.col("begin") + took).alias("end"), "shard")
                            .filter("end > begin"), "ring-pieces"))
        state = written(state.join(done[-1].select("arc", "end"), "arc", "left")
                        .select("arc", "home", "bytes", F.coalesce("end", "begin").alias("begin")), "ring-state")
    return _all(done)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def place(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, slack: int = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, home, shard, slot (place in its shard) for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    along = keys(docs, shards, virtual).repartitionByRange(*ALONG).withColumn("bucket", F.spark_partition_id())
    along = written(along, "ring-keys")
    sums = along.groupBy("arc").agg(F.sum("size").alias("bytes"))
    arcs = (ring(spark, shards, virtual).select("arc", F.col("shard").alias("home")).distinct()
            .join(sums, "arc", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("long"))))
    went = pieces(arcs, shards, slack)
    begun = running_sum(along, ["arc"], "bucket", ALONG, "size", "start")
    # as many rows as virtual nodes, and one for each shard that ran full
    put = begun.join(F.broadcast(went), "arc").filter("start >= begin and start < end")
    return (running_sum(put.withColumn("one", F.lit(1).cast("long")), ["shard"], "bucket", ALONG, "one", "slot")
            .select("doc_id", "size", "text_crc32", "home", "shard", "slot"))
