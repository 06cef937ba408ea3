"""Streaming results equal their batch forms (AvailableNow)."""

from pyspark.sql import functions as F

from feedlake.plans import catalog
from feedlake.sources import fixtures as fx


def test_stream_week_counts_equal_batch(spark, base):
    got = {(r.week_start, r.n) for r in catalog.QUERIES["stream_week_counts"](spark, base).collect()}
    v = fx.verdicts(spark, base).filter("kept")
    exp = {(r.w, r.n) for r in v.groupBy(F.date_trunc("week", "published_at").cast("timestamp_ntz").alias("w"))
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == exp


def test_stream_dedup_one_row_per_hash(spark, base):
    df = catalog.QUERIES["stream_dedup"](spark, base)
    assert df.count() == fx.verdicts(spark, base).select("hash").distinct().count()


def test_stream_digest_equals_batch(spark, base):
    s = catalog.QUERIES["stream_digest"](spark, base).select("run_ts", "rank", "entry_id")
    b = catalog.QUERIES["daily_top"](spark, base).select("run_ts", "rank", "entry_id")
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_stream_daily_with_gate_is_idempotent(spark, base):
    from feedlake.operators import select as sel
    from feedlake.plans.q_stream import _verdict_stream, verdict_frame
    from feedlake.session import scratch_path
    from feedlake.sources import store as ST
    from feedlake.streaming import stream as STR

    def prepare(df):
        return (df.withColumn("run_ts", fx.run_of(F.col("published_at")))
                .withColumn("response_pos", F.col("entry_id").cast("int")).drop("event_ts"))

    ledger, store = scratch_path(spark, "s-ledger"), scratch_path(spark, "s-store")
    writer = STR.daily_batch_writer(lambda b: sel.daily_top(b).drop("rank"), ledger, store)
    out = STR.run_to_table(prepare(_verdict_stream(spark, base)), "s-daily", batch_fn=writer)
    top = spark.read.parquet(out)
    n_hashes = fx.verdicts(spark, base).select("hash").distinct().count()
    assert ST.read_ledger(spark, ledger).count() == n_hashes
    stored = sorted(map(tuple, ST.read_store(spark, store).select("hash", "entry_id", "run_ts").collect()))
    assert len(stored) == top.select("hash").distinct().count()
    # replay batch 0 (as after a failure): ledger view and store are unchanged
    static = prepare(verdict_frame(spark.read.parquet(f"{base}/events.parquet")))
    writer(static, 0, out)
    assert ST.read_ledger(spark, ledger).count() == n_hashes
    again = sorted(map(tuple, ST.read_store(spark, store).select("hash", "entry_id", "run_ts").collect()))
    assert again == stored


def _in_files(spark, base, n=3, future=True):
    """The events in several files, one of them with a date far ahead first."""
    from feedlake.session import scratch_path
    path = scratch_path(spark, "event-files")
    ev = spark.read.parquet(f"{base}/events.parquet")
    if future:
        ahead = ev.filter("event_id = 0").withColumn("ts", F.lit("2031-01-01 00:00:00").cast(ev.schema["ts"].dataType)) \
            .withColumn("event_id", F.lit(-2).cast("bigint"))
        ahead.coalesce(1).write.parquet(path)
    for k in range(n):
        ev.filter(F.col("event_id") % n == k).coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path)


def test_dedup_over_micro_batches_with_a_future_date(spark, base):
    from feedlake.plans.q_stream import verdict_frame
    from feedlake.streaming import stream as STR
    path, static = _in_files(spark, base)
    live = verdict_frame(STR.file_stream(spark, path, "*.parquet", max_files=1))
    out = spark.read.parquet(STR.run_to_table(STR.dedup(live), "dedup"))
    want = verdict_frame(static).select("hash").distinct()
    assert out.count() == want.count() and want.exceptAll(out.select("hash")).count() == 0


def test_digest_over_micro_batches_and_restart(spark, base):
    """One file for each trigger: a run's items come in several batches; the query is stopped and goes on."""
    from feedlake.operators import select as sel
    from feedlake.plans.q_stream import verdict_frame
    from feedlake.session import scratch_path
    from feedlake.streaming import stream as STR

    def prepared(df):
        return (verdict_frame(df).withColumn("run_ts", fx.run_of(F.col("published_at")))
                .withColumn("response_pos", F.col("entry_id")).drop("event_ts"))

    path, static = _in_files(spark, base)
    keep = scratch_path(spark, "digest-query")
    writer = STR.merge_by_run(sel.daily_top)
    out = STR.run_to_table(prepared(STR.file_stream(spark, path, "*.parquet", max_files=1)), "d", batch_fn=writer, path=keep)
    more = static.filter("event_id >= 0").limit(40).withColumn("event_id", F.col("event_id") + 1_000_000)
    more.coalesce(1).write.mode("append").parquet(path)
    STR.run_to_table(prepared(STR.file_stream(spark, path, "*.parquet", max_files=1)), "d", batch_fn=writer, path=keep)
    cols = ["run_ts", "rank", "entry_id"]
    got = spark.read.parquet(out).select(cols)
    want = sel.daily_top(prepared(spark.read.parquet(path))).select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_daily_writer_leaves_out_what_earlier_runs_handled(spark, base):
    from feedlake.operators import select as sel
    from feedlake.plans.q_stream import verdict_frame
    from feedlake.session import scratch_path
    from feedlake.sources import store as ST
    from feedlake.streaming import stream as STR
    ledger, store = scratch_path(spark, "w-ledger"), scratch_path(spark, "w-store")
    path, static = _in_files(spark, base, future=False)

    def prepared(df):
        return (verdict_frame(df).withColumn("run_ts", fx.run_of(F.col("published_at")))
                .withColumn("response_pos", F.col("entry_id")).drop("event_ts", "seen_at"))

    known = fx.ledger(spark, base)
    ST.append_ledger(known, ledger)
    writer = STR.daily_batch_writer(lambda b: sel.daily_top(b).drop("rank"), ledger, store)
    out = STR.run_to_table(prepared(STR.file_stream(spark, path, "*.parquet", max_files=1)), "w", batch_fn=writer)
    shown = spark.read.parquet(out)
    early = shown.join(known.select("hash", F.col("seen_at").alias("s")), "hash").filter("s < run_ts")
    assert early.count() == 0
    assert shown.groupBy("run_ts").count().agg(F.max("count")).first()[0] <= 3
    assert ST.read_ledger(spark, ledger).count() == static.transform(prepared).select("hash").distinct().count()
