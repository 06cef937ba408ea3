"""Mixing sources to target weights by a low-discrepancy schedule.

DataFrame functions only.  Each source's documents are shuffled (by a hash of
doc_id) into one stream of words, cut into blocks of equal length.  The schedule
has a slot for each block of the mix: slot k's point is the fractional part of k
times the golden ratio, in 31 bits, mapped through the sources' cumulative
targets.  A source's r-th slot takes its stream's r-th block; a stream repeats
after its end, up to ``max_repeat`` times.  So the schedule alone says how much of
a source is taken and where in the mix it stands; the points' low discrepancy
keeps every prefix of it, and the whole, within a few blocks of the targets.
Blocks hold BLOCK_WORDS words, or twice that and so on where the schedule would
have more than MOST_SLOTS slots.

Targets: the weights share ``share`` of all words; a target stops at
``max_repeat`` times its source's words and the excess goes to the others by
weight, until none is above (one water level: least(cap, level * weight)).

Edge cases: a null text has size 0; sizes of 0 take 0; a null source is a
source of its own, in last place; a null doc_id shuffles as an empty string;
repeated rows are rows of their own (one result each); an empty table gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.prefix import running_sum
from feedlake.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 32
MOST_SLOTS = 1 << 27
#: Steps of the cumulative targets for each block.
STEPS = 16
#: Golden-ratio multiplier for points of POINT_BITS bits (2^31 / 1.618..., odd).
GOLDEN, POINT_BITS = 1327217885, 31
CHUNK_BITS = 9
PART_BITS = 12
#: Documents of a source that one window sums.
BUCKET_DOCS = 512
#: Source tables up to this many rows are broadcast; larger ones are left to the planner.
BROADCAST_SOURCES = 20_000


def source_key() -> Column:
    """Order key of a source: by code point, null last; never null."""
    return F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), "source"))


def place() -> list[Column]:
    """A document's place in its source's shuffled order."""
    return [F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"), F.col("doc_id")]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, its order key, size in words, and the shuffling hash."""
    return docs.select(
        "source", source_key().alias("skey"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"), *place())


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
            max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row for each source: skey, n_docs, source_size, target."""
    by_source = sizes.groupBy("skey").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("skey")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    level = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    rest = (F.col("total") - F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (by_source.withColumn("weight", weight)
            .withColumn("cap", max_repeat * F.col("source_size"))
            .withColumn("total", F.floor(F.sum("source_size").over(everything) * F.lit(share)).cast("long"))
            .withColumn("rest", rest)
            .withColumn("open", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("level", F.max(F.when(F.col("rest") * F.col("weight") <= F.col("cap") * F.col("open"),
                                              F.col("rest") / F.col("open"))).over(everything))
            .select("skey", "n_docs", "source_size",
                    F.least(F.col("cap").cast("double"),
                            F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))).alias("target")))


def block_length(words: int) -> int:
    """Words of a block in a mix of so many words."""
    block = BLOCK_WORDS
    while words > block * MOST_SLOTS:
        block *= 2
    return block


def points(slots: DataFrame) -> DataFrame:
    """``slots`` (id) with ``point``: the golden-ratio sequence in POINT_BITS bits."""
    return slots.withColumn("point", (F.col("id") * GOLDEN) % (1 << POINT_BITS))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: skey, rank (the block of the source's stream), slot (place in the mix).

    ``sources``: skey and want (words to take, as near as the points allow).
    """
    spark = sources.sparkSession
    need = sources.withColumn("need", F.floor(F.col("want") * STEPS / block_words)).filter("need > 0")
    total, words = need.agg(F.coalesce(F.sum("need"), F.lit(0)), F.coalesce(F.sum("want"), F.lit(0))).first()
    n_slots = -(-words // block_words)
    if n_slots >= 1 << POINT_BITS:
        raise ValueError(f"{n_slots} slots of {block_words} words; raise block_words")
    begin = F.coalesce(F.sum("need").over(Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = (need.withColumn("begin", begin)
             .withColumn("chunk", F.explode(F.sequence(F.shiftright("begin", CHUNK_BITS),
                                                       F.shiftright(F.col("begin") + F.col("need") - 1, CHUNK_BITS))))
             .select("chunk", F.greatest("begin", F.shiftleft("chunk", CHUNK_BITS)).alias("at"),
                     F.lit(None).cast("long").alias("slot"), "skey"))
    at = F.floor(F.col("point") * F.lit(total / (1 << POINT_BITS)))
    slots = (points(spark.range(n_slots)).withColumn("at", at)
             .select(F.shiftright("at", CHUNK_BITS).alias("chunk"), "at", F.col("id").alias("slot"),
                     F.lit(None).cast("string").alias("skey")))
    last = (Window.partitionBy("chunk").orderBy("at", F.col("slot").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, 0))
    mapped = (spans.unionByName(slots)
              .select("slot", F.last("skey", ignorenulls=True).over(last).alias("skey"))
              .filter("slot is not null")
              .withColumn("part", F.shiftright("slot", PART_BITS)).withColumn("one", F.lit(1)))
    mapped = written(mapped, "slots")
    return running_sum(mapped, ["skey"], "part", ["slot"], "one", "rank").select("skey", "rank", "slot")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, max_repeat: int = MAX_REPEAT,
        block_words: int | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, slot: one row for each row of ``docs``.

    ``taken``: words of the document in the blocks that its source's slots take;
    ``slot``: the first slot that holds some of it (null: none).
    """
    sizes = written(sized(docs), "sizes")
    sources = written(targets(sizes, weights, share, max_repeat).withColumn("want", F.floor("target").cast("long")),
                      "sources")
    n_sources, words = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("want"), F.lit(0))).first()
    block = block_words or block_length(words)
    slots = written(schedule(sources.select("skey", "want"), block), "schedule")
    drawn = slots.groupBy("skey").agg((F.count(F.lit(1)) * block).alias("drawn"))
    sources = written(sources.join(drawn, "skey", "left").withColumn(
        "drawn", F.least(F.coalesce("drawn", F.lit(0)), max_repeat * F.col("source_size"))), "drawn")
    n_buckets = F.ceil(F.col("n_docs") / BUCKET_DOCS)
    prefix = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    order = ["h", "doc_id", "size"]
    placed = (sizes.join(F.broadcast(sources) if n_sources <= BROADCAST_SOURCES else sources, "skey")
              .withColumn("bucket", F.shiftright(prefix * n_buckets, 32))
              .withColumn("row", F.row_number().over(Window.partitionBy("skey", "bucket").orderBy(*order))))
    # rows of equal order keys are equal rows: either may come first
    placed = running_sum(placed, ["skey"], "bucket", ["row"], "size", "start")
    inside = [F.greatest(F.lit(0), F.least(F.col("start") + F.col("size") + e * F.col("source_size"), F.col("drawn"))
                         - F.col("start") - e * F.col("source_size")) for e in range(max_repeat)]
    taken = placed.withColumn("taken", sum(inside[1:], inside[0]).cast("long"))
    first = F.when(F.col("taken") > 0, F.floor(F.col("start") / block))
    return taken.withColumn("rank", first).join(slots, ["skey", "rank"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "taken", "slot")


#: The same targets, points and slots; BLOCK_WORDS and STEPS as in a small mix.
ORACLE_SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as h,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
by_source as (
  select source, cast(sum(size) as bigint) as source_size,
         [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as integer)] as weight
  from sized group by source),
capped as (
  select *, 3 * source_size as cap, cast(sum(source_size) over () as bigint) as total from by_source),
levelled as (
  select *, cast(total - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                  rows between unbounded preceding and 1 preceding), 0) as bigint) as rest,
         cast(sum(weight) over (order by cap / weight, source nulls last
                                rows between current row and unbounded following) as bigint) as open
  from capped),
target as (
  select source, source_size,
         least(cast(cap as double),
               max(case when rest * weight <= cap * open then cast(rest as double) / open end) over () * weight) as target
  from levelled),
spans as (
  select *, cast(floor(floor(target) * 16 / 32) as bigint) as need,
         cast(sum(floor(floor(target) * 16 / 32)) over (order by source nulls last) as bigint) as reach from target),
slots as (
  select k as slot, cast(floor(((k * 1327217885) % 2147483648) * (total / 2147483648)) as bigint) as spot
  from (select cast(sum(need) as double) as total, cast(ceil(sum(floor(target)) / 32) as bigint) as n
        from spans where need > 0) t, range(0, t.n) r(k)),
ranked as (
  select source, slot, row_number() over (partition by source order by slot) - 1 as rank
  from slots join spans on spot >= reach - need and spot < reach),
drawn as (
  select t.source, t.source_size, t.target, least(32 * count(r.slot), 3 * t.source_size) as want
  from target t left join ranked r on r.source is not distinct from t.source
  group by t.source, t.source_size, t.target),
placed as (
  select s.doc_id, s.size, t.source, t.source_size, t.target, t.want,
         cast(coalesce(sum(s.size) over (partition by s.source order by s.h, s.doc_id, s.size
                                rows between unbounded preceding and 1 preceding), 0) as bigint) as lo
  from sized s join drawn t on s.source is not distinct from t.source),
filled as (
  select *, cast(greatest(0, least(lo + size, want) - lo)
               + greatest(0, least(source_size + lo + size, want) - (source_size + lo))
               + greatest(0, least(2 * source_size + lo + size, want) - (2 * source_size + lo)) as bigint) as taken
  from placed)
select f.doc_id, f.size, f.source_size, f.target, f.taken, r.slot
from filled f left join ranked r on r.source is not distinct from f.source and r.rank = f.lo // 32 and f.taken > 0
"""
