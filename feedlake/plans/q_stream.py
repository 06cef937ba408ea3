"""Registered queries: streaming ingest, dedup, week counts, digest."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.functions import coerce as C
from feedlake.functions.text import item_hash
from feedlake.operators import ledger as LG
from feedlake.operators import select as sel
from feedlake.plans.catalog import register
from feedlake.plans.oracle_views import with_views
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx
from feedlake.streaming import ledger as SL
from feedlake.streaming import stream as ST
from feedlake.streaming import weeks as SW


def _verdict_stream(spark, base):
    """The verdict fixture computed on a file stream of events."""
    return verdict_frame(ST.file_stream(spark, base, "events.parquet"))


def verdict_frame(ev):
    """Verdict columns from an events frame (streaming or static)."""
    et = F.col("event_type")
    arrival = ["seen_at"] if "seen_at" in ev.columns else []
    raw = ev.select(
        *arrival, F.col("event_id").alias("entry_id"), et.alias("source"),
        F.concat(F.lit("https://"), et, F.lit(".example.com/"), F.col("user_id").cast("string"),
                 F.lit("/"), F.get_json_object("props", "$.k")).alias("link"),
        F.col("ts").alias("published_at"),
        F.when(et == "error", "critical").when(et == "purchase", "important")
        .when(et == "click", "notable").when(et == "view", "ignore").otherwise("urgent")
        .alias("raw_severity"),
        F.col("value").alias("raw_score"), (F.col("event_id") % 2 == 0).alias("kept"))
    v = raw.select(*arrival, "entry_id", "source", "link", "published_at", "kept",
                   item_hash(F.col("link")).alias("hash"),
                   C.allow_severity(F.col("raw_severity")).alias("severity"),
                   C.clamp_score(F.col("raw_score").cast("int")).alias("score"))
    return ST.with_event_time(v)


# ------------------------------------------------------------------ T1
@register("stream_ingest", with_views("""
select entry_id, source, link, published_at, kept, hash, severity, score from v_verdicts""",
                                      "v_verdicts"))
def q_stream_ingest(spark, base):
    out = ST.run_to_table(_verdict_stream(spark, base), "stream-ingest")
    return spark.read.parquet(out).select("entry_id", "source", "link", "published_at", "kept",
                                          "hash", "severity", "score")


# ------------------------------------------------------------------ T2
@register("stream_dedup", with_views("select distinct hash from v_verdicts", "v_verdicts"))
def q_stream_dedup(spark, base):
    """One row per hash survives (which duplicate is first depends on arrival)."""
    out = ST.run_to_table(ST.dedup(_verdict_stream(spark, base)), "stream-dedup")
    return spark.read.parquet(out).select("hash")


# ------------------------------------------------------------------ T2, K2 with state
#: Days that the query's ledger keeps a row.
LEDGER_DAYS = 10
#: Parts of the queries' state; a job on a cluster gives its own.
STATE_PARTITIONS = 8
#: Parts of the ledger query's state, and about as many marks as one of its buckets gets.
LEDGER_PARTITIONS, BUCKET_MARKS = 16, 2000
#: Files of the ledger query's marks, and as many of them as one micro-batch reads.
MARK_FILES, FILES_PER_BATCH = 12, 4


def _mark_files(spark, base, n=MARK_FILES):
    """The verdicts' marks in several files, each with rows of the whole period."""
    path = scratch_path(spark, "mark-files")
    marks = fx.verdicts(spark, base).select("hash", F.concat("link", F.lit("#"), F.col("entry_id").cast("string")).alias("url"),
                                            F.col("published_at").alias("seen_at"))
    marks.repartition(n, "url").write.parquet(path)
    return path


@register("stream_ledger", with_views(f"""
with recursive marks as (
  select hash, link || '#' || cast(entry_id as varchar) as url, published_at as seen_at from v_verdicts),
rows_ as (
  select hash, min(seen_at) as seen_at from marks group by hash
  union all
  select m.hash, min(m.seen_at) from rows_ r join marks m on m.hash = r.hash
  where m.seen_at > r.seen_at + interval {LEDGER_DAYS} days group by m.hash)
select r.hash, min(m.url) as url, r.seen_at from rows_ r join marks m on m.hash = r.hash and m.seen_at = r.seen_at
where r.seen_at >= (select max(seen_at) from marks) - interval {LEDGER_DAYS} days
group by r.hash, r.seen_at""", "v_verdicts"))
def q_stream_ledger(spark, base):
    """The ledger kept by a stream over files in any order, stopped and restarted, then read with its purge."""
    files = _mark_files(spark, base)
    landed = spark.read.parquet(files)
    now, n = landed.agg(F.max("seen_at"), F.count(F.lit(1))).first()
    keep = scratch_path(spark, "ledger-query")
    for glob in (f"part-0000[0-{FILES_PER_BATCH - 1}]*.parquet", "*.parquet"):  # the second run goes on after the first
        live = (spark.readStream.schema(landed.schema).option("pathGlobFilter", glob)
                .option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(files))
        out = SL.run_ledger(live, LEDGER_DAYS, late="60 days", path=keep, partitions=LEDGER_PARTITIONS,
                            buckets=max(4 * LEDGER_PARTITIONS, n // BUCKET_MARKS))
    return LG.purge(SL.ledger_rows(spark, out), F.lit(now), LEDGER_DAYS)


# ------------------------------------------------------------------ T3
@register("stream_week_counts", with_views("""
select date_trunc('week', published_at) as week_start, count(*) as n
from v_verdicts where kept group by 1""", "v_verdicts"))
def q_stream_week_counts(spark, base):
    kept = _verdict_stream(spark, base).filter("kept")
    out = ST.run_to_table(ST.week_counts(kept), "stream-weeks", output_mode="complete")
    return spark.read.parquet(out)


# ------------------------------------------------------------------ T4
@register("stream_digest", with_views("""
select run_ts, cast(rank as int) as rank, entry_id, hash, severity, score
from (select *, row_number() over (partition by run_ts order by severity_rank, score desc, response_pos) as rank
      from v_daily where kept and severity in ('critical', 'important')) t
where rank <= 3""", "v_daily"))
def q_stream_digest(spark, base):
    """Daily priority pick, merged by run over micro-batches."""
    v = (_verdict_stream(spark, base)
         .withColumn("run_ts", fx.run_of(F.col("published_at")))
         .withColumn("response_pos", F.col("entry_id")))

    out = ST.run_to_table(v, "stream-digest", batch_fn=ST.merge_by_run(sel.daily_top))
    return spark.read.parquet(out).select("run_ts", F.col("rank").cast("int"), "entry_id", "hash",
                                          "severity", "score")


# ------------------------------------------------------------------ T1 on landed feeds
@register("stream_feeds", with_views("""
select source, link, trim(title) as title from v_entries
union all select * from (values
  ('cutoff.example.org', 'https://cutoff.example.org/a', 'Kept entry'),
  ('nolink.example.org', null, 'No link here')) b(source, link, title)""", "v_entries"))
def q_stream_feeds(spark, base):
    """Landed RSS and Atom files as a stream; the good entries of broken files stay."""
    from feedlake.sources import feeds as FD
    landed = FD.read_feeds(spark, fx.feed_docs(spark, base), stream=True)
    good = landed.filter(F.col("_corrupt_record").isNull()).select("source", "link", F.trim("title").alias("title"))
    return spark.read.parquet(ST.run_to_table(good, "stream-feeds"))


# ------------------------------------------------------------------ T5: weeks close on the stream
@register("stream_week_close", with_views("""
with rows_ as (
  select strftime(published_at, '%G-W%V') as week, entry_id, hash, published_at, category, score,
         case severity when 'critical' then 0 when 'important' then 1 when 'notable' then 2 else 3 end as severity_rank,
         cast(cast(published_at as date) as timestamp) + interval 27 hours as run_ts,
         date_trunc('week', published_at) + interval '6 days 15 hours' as due
  from v_verdicts where kept),
closed as (select distinct week from rows_ where run_ts <= due and due <= (select max(run_ts) from rows_)),
editions as (
  select 'closed' as edition, r.* from rows_ r semi join closed c on c.week = r.week where run_ts <= due
  union all
  select 'rebuilt', r.* from rows_ r semi join closed c on c.week = r.week
  semi join (select week from rows_ where run_ts > due) l on l.week = r.week),
counted as (
  select week, edition, cast(sum(n) as bigint) as n_kept, cast(sum(n_late) as bigint) as n_late,
         string_agg(category || ':' || n, ',' order by category) as counts
  from (select week, edition, category, count(*) as n, count(*) filter (where run_ts > due) as n_late
        from editions group by all) c group by week, edition),
first_ as (
  select week, edition, string_agg(cast(entry_id as varchar), ',' order by rank) as top
  from (select *, row_number() over (partition by week, edition order by severity_rank, score desc, published_at, hash, entry_id) as rank
        from editions) r where rank <= 3 group by week, edition)
select week, edition, n_kept, n_late, counts, top from counted join first_ using (week, edition)""", "v_verdicts"))
def q_stream_week_close(spark, base):
    """Recaps as they close on the stream, one file of several days after the other, and again with their late items."""
    path = scratch_path(spark, "verdict-files")
    rows = (fx.daily_verdicts(spark, base).filter("kept")
            .select("run_ts", "published_at", "hash", "entry_id", "severity", "score", "category"))
    first, last = rows.agg(F.min("run_ts"), F.max("run_ts")).first()
    step = (last - first) / 3
    for k in range(3):  # a file is read after those that landed before it
        inside = F.col("run_ts") >= F.lit(first + k * step).cast("timestamp_ntz")
        if k < 2:
            inside &= F.col("run_ts") < F.lit(first + (k + 1) * step).cast("timestamp_ntz")
        rows.filter(inside).coalesce(1).write.mode("append").parquet(path)
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return SW.read_recaps(spark, SW.run_weeks(live, partitions=STATE_PARTITIONS))


# ------------------------------------------------------------------ T5 on the stream
@register("stream_late_items", with_views("""
select strftime(published_at, '%G-W%V') as week, entry_id, published_at,
       cast(cast(published_at as date) as timestamp) + interval 27 hours as run_ts
from v_verdicts
where kept and cast(cast(published_at as date) as timestamp) + interval 27 hours
      > date_trunc('week', published_at) + interval '6 days 15 hours'""", "v_verdicts"))
def q_stream_late_items(spark, base):
    """Kept verdicts arriving after their week's recap ran, flagged as the
    stream flows (a stateless test per row); their weeks are rebuilt."""
    from feedlake.functions.dates import week_label
    from feedlake.operators import weekly as W
    v = (_verdict_stream(spark, base).filter("kept")
         .withColumn("run_ts", fx.run_of(F.col("published_at")))
         .withColumn("week", week_label(F.col("published_at"))))
    out = ST.run_to_table(W.late_items(v), "stream-late")
    return spark.read.parquet(out).select("week", "entry_id", "published_at", "run_ts")
