"""End-to-end daily and weekly jobs on table-backed ledger and store."""

import glob

from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.plans.daily import run_daily
from feedlake.plans.weekly import run_weekly
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx
from feedlake.sources import store as ST


def test_daily_then_weekly(spark, base):
    ledger = scratch_path(spark, "ledger")
    store = scratch_path(spark, "store")
    items = fx.daily_items(spark, base).drop("run_ts", "response_pos")
    runs = fx.runs(spark, base)
    answers = fx.responses(spark, base).withColumn("run_ts", fx.run_of(F.col("day")))
    out = run_daily(spark, items, None, runs, ledger, store, answers=answers)
    n_new = out["new"].count()
    assert n_new > 0
    # every new hash is now in the ledger, so a replay finds nothing new
    assert ST.read_ledger(spark, ledger).count() == out["new"].select("hash").distinct().count()
    replay = run_daily(spark, items, None, runs, ledger, store, answers=answers, commit=False)
    assert replay["new"].count() == 0
    stored = ST.read_store(spark, store)
    assert stored.count() > 0
    assert stored.count() == stored.select("hash").distinct().count()
    assert stored.count() == out["digest_items"].select("hash").distinct().count()
    top = out["digest_items"].filter("section = 'top'")
    assert top.groupBy("run_ts").count().agg(F.max("count")).first()[0] <= 3
    assert out["payload"].count() == out["header"].count()
    counts = {(r.run_ts, r.stage): r.n for r in out["stage_counts"].collect()}
    for (run, stage), n in counts.items():
        if stage == "new":
            assert n <= counts[(run, "recent")]

    rep = scratch_path(spark, "reports")
    w = run_weekly(spark, store, report_path=rep)
    weeks = {r.week for r in stored.filter("kept").select("week").distinct().collect()}
    assert weeks
    assert {p.rsplit("/", 1)[1] for p in glob.glob(f"{rep}/*")} == {f"{w}.md" for w in weeks}
    assert w["top"].groupBy("week").count().agg(F.max("count")).first()[0] == 3
    assert w["payload"].count() == len(weeks)


def test_daily_rule_scorer_on_feeds(spark, base):
    """Without answers the rule scorer stands in for the model."""
    ledger = scratch_path(spark, "ledger-r")
    store = scratch_path(spark, "store-r")
    entries = fx.entries(spark, base).withColumn("entry_pos", F.col("entry_id"))
    runs = entries.select(fx.run_of(F.col("published_at")).alias("run_ts")).distinct()
    out = run_daily(spark, entries, fx.sources_registry(spark, base), runs, ledger, store)
    assert out["verdicts"].count() == out["new"].count()
    assert out["header"].count() == out["new"].select("run_ts").distinct().count()


def test_upsert_store_moves_week(spark):
    from datetime import datetime
    path = scratch_path(spark, "store-move")
    cols = "hash string, published_at timestamp_ntz, kept boolean, recorded_at timestamp_ntz, response_pos int"
    first = spark.createDataFrame([("h1", datetime(2026, 5, 26), True, datetime(2026, 5, 27), 1),
                                   ("h2", datetime(2026, 5, 26), True, datetime(2026, 5, 27), 2)], cols)
    ST.upsert_store(spark, first, path)
    moved = spark.createDataFrame([("h1", datetime(2026, 6, 2), True, datetime(2026, 6, 3), 1)], cols)
    ST.upsert_store(spark, moved, path)
    got = {(r.hash, r.week) for r in ST.read_store(spark, path).collect()}
    assert got == {("h1", "2026-W23"), ("h2", "2026-W22")}
    ST.upsert_store(spark, moved, path)        # idempotent
    assert ST.read_store(spark, path).count() == 2


def test_rebuild_late_weeks(spark, base):
    from feedlake.operators import weekly as W
    from feedlake.plans.weekly import rebuild_late_weeks
    store = scratch_path(spark, "store-late")
    v = fx.daily_verdicts(spark, base).filter("kept").withColumn("recorded_at", F.col("run_ts"))
    ST.upsert_store(spark, v, store)
    stored = ST.read_store(spark, store)
    late = W.late_items(stored)
    late_weeks = {r.week for r in late.select("week").distinct().collect()}
    out = rebuild_late_weeks(spark, store, late)
    assert {r.week for r in out["lines"].select("week").distinct().collect()} == late_weeks


def test_feed_stream_equals_batch(spark, base):
    """Landed XML feeds read as a stream (AvailableNow) give the batch rows."""
    from feedlake.sources import feeds as FD
    from feedlake.streaming import stream as STR
    path = fx.feed_docs(spark, base)
    batch = FD.entries(FD.read_feeds(spark, path)).select("source", "link", "title")
    out = STR.run_to_table(FD.read_feeds(spark, path, stream=True)
                           .filter(F.col("_corrupt_record").isNull())
                           .select("source", "link", "title"), "feed-stream")
    streamed = spark.read.parquet(out)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_rule_table_join_equals_case(spark, base):
    from feedlake.functions.text import clean_html
    from feedlake.operators import scoring as S
    from feedlake.plans.q_feeds import FIXTURE_RULES
    e = fx.entries(spark, base)
    text = S.rule_text(F.col("title"), clean_html(F.col("summary")))
    case = S.rubric_score(e, text, FIXTURE_RULES).select("entry_id", "rule_id", "severity", "score")
    rules = spark.createDataFrame(FIXTURE_RULES, S.RULE_SCHEMA)
    joined = S.rubric_join(e, text, rules).select("entry_id", "rule_id", "severity", "score")
    assert case.exceptAll(joined).count() == 0 and joined.exceptAll(case).count() == 0


def test_cut_off_feed_keeps_good_entries(spark, base):
    from feedlake.sources import feeds as FD
    path = fx.feed_docs(spark, base)
    feeds = FD.read_feeds(spark, path)
    links = {r.link for r in FD.entries(feeds).filter(F.col("source") == "cutoff.example.org").collect()}
    assert "https://cutoff.example.org/a" in links
    bad = {r.source: r.n_corrupt for r in FD.quarantine(feeds).collect()}
    assert set(bad) == {"cutoff.example.org", "garbage.example.org"}
    # the entry without a link is read, then rejected by the required-field rule
    from feedlake.operators.ingest import entry_rejections
    rej = entry_rejections(FD.entries(feeds)).filter(F.col("source") == "nolink.example.org").collect()
    assert [r.reason for r in rej] == ["missing_link"]


def test_no_feed_file_grows_with_its_source(spark):
    """Files are read whole: a busy source, its links repeated or not, fills many bounded ones of either format."""
    from feedlake.sources import feeds as FD
    n = 5 * FD.ENTRIES_PER_FILE // 2
    df = spark.range(n).select(
        F.lit("busy.example.org").alias("source"), F.concat(F.lit("Title "), F.col("id").cast("string")).alias("title"),
        F.concat(F.lit("https://busy.example.org/"), (F.col("id") % 7).cast("string")).alias("link"),
        F.lit("text").alias("summary"), F.lit("2024-01-08 10:00:00").cast("timestamp_ntz").alias("published_at"))
    for write in (FD.write_rss, FD.write_atom):
        path = scratch_path(spark, "busy")
        write(df, path)
        found = FD.entries(FD.read_feeds(spark, path))
        sizes = [r["count"] for r in found.groupBy("file").count().collect()]
        assert max(sizes) <= FD.ENTRIES_PER_FILE and sum(sizes) == n
        assert found.select("title").distinct().count() == n


def test_an_entry_does_not_carry_its_file(spark, base):
    """The rows of the explode hold their own entry only; with the file's beside it a file would cost its square."""
    import re

    from feedlake.sources import feeds as FD
    plan = FD.read_feeds(spark, fx.feed_docs(spark, base))._jdf.queryExecution().executedPlan().toString()
    beside = re.search(r"Generate posexplode\(.*\), \[([^\]]*)\], false", plan).group(1)
    assert {c.split("#")[0] for c in beside.split(", ")} == {"source", "file", "fetched_at", "__n"}



def _landed(spark, n=6):
    """RSS and Atom files of a few entries that rules match, dated now."""
    from datetime import datetime, timedelta, timezone

    from feedlake.sources import feeds as FD
    now = datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(hours=1)
    rows = [(f"s{i % 2}.example.org", f"Critical vulnerability CVE-2024-{1000 + i} in the kernel", f"https://s{i % 2}.example.org/{i}",
             "remote code execution security flaw", now) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "source string, title string, link string, summary string, published_at timestamp_ntz")
    path = scratch_path(spark, "landed")
    FD.write_rss(df.filter("source = 's0.example.org'"), path)
    FD.write_atom(df.filter("source = 's1.example.org'"), path)
    src = scratch_path(spark, "registry")
    (spark.createDataFrame([(f"s{i}.example.org", f"https://s{i}.example.org/feed", "security") for i in (0, 1)],
                           "source string, url string, category string")
     .coalesce(1).write.option("header", True).csv(src))
    return path, src


def _cli(spark, feeds, src, extra=(), paths=None):
    from feedlake.__main__ import main
    ledger, store, out = paths or (scratch_path(spark, n) for n in ("ledger", "store", "out"))
    main(["daily", "--feeds", feeds, "--sources", src, "--ledger", ledger, "--store", store, "--out", out, *extra])
    return ledger, store, out


def test_cli_default_run_commits_once(spark):
    """Without --runs the job's own time is the run: marks and verdicts are written, a second job has nothing new."""
    feeds, src = _landed(spark)
    ledger, store, out = _cli(spark, feeds, src)
    assert ST.read_ledger(spark, ledger).count() == 12
    kept = ST.read_store(spark, store).collect()
    assert len(kept) == 12 and {r.severity for r in kept} <= {"critical", "important", "notable"}
    assert len(spark.read.text(f"{out}/payloads").collect()) == 1
    positions = spark.read.json(f"{out}/requests").collect()
    assert sum(r.n_items for r in positions) == 12
    again = _cli(spark, feeds, src, paths=(ledger, store, out + "-2"))[2]
    assert not glob.glob(f"{again}/payloads/run_ts=*") and ST.read_ledger(spark, ledger).count() == 12


def test_cli_items_are_visible_once_landed(spark):
    feeds, src = _landed(spark)
    ledger, _, _ = _cli(spark, feeds, src, ["--runs", "2020-01-01 00:00:00"])
    assert ST.read_ledger(spark, ledger).count() == 0


def test_cli_reported_failure_commits_nothing(spark):
    import json
    feeds, src = _landed(spark)
    run = "2100-01-01 00:00:00"
    status = scratch_path(spark, "status")
    spark.createDataFrame([(json.dumps({"run_ts": run, "ok": False}),)], "value string").write.text(status)
    ledger, store, out = _cli(spark, feeds, src, ["--runs", run, "--hours", "9000000", "--status", status])
    assert glob.glob(f"{out}/payloads/run_ts=*") and ST.read_ledger(spark, ledger).count() == 0
    assert ST.read_store(spark, store).count() == 0


def test_failing_publication_commits_nothing(spark, base):
    import pytest
    ledger, store = scratch_path(spark, "ledger-f"), scratch_path(spark, "store-f")
    items = fx.daily_items(spark, base).drop("run_ts", "response_pos")

    def publish(payload):
        raise OSError("no way out")

    with pytest.raises(OSError):
        run_daily(spark, items, None, fx.runs(spark, base), ledger, store,
                  answers=fx.flawed_responses(spark, base), publish=publish)
    assert ST.read_ledger(spark, ledger).count() == 0 and ST.read_store(spark, store).count() == 0


def test_reference_answers_and_missing_answers(spark, base):
    """Answers in the original's schema give the same digest; runs without one fall back, header included."""
    items = fx.daily_items(spark, base).drop("run_ts", "response_pos")
    runs = fx.runs(spark, base)
    paths = [scratch_path(spark, n) for n in ("l1", "s1")]
    docs = fx.reference_responses(spark, base).withColumn("run_ts", fx.run_of(F.col("day")))
    ours = run_daily(spark, items, None, runs, *paths, answers=fx.responses(spark, base).withColumn(
        "run_ts", fx.run_of(F.col("day"))), commit=False)["digest_items"]
    theirs = run_daily(spark, items, None, runs, *paths, answers=docs, commit=False)["digest_items"]
    cols = ["run_ts", "section", "rank", "entry_id", "severity", "category"]
    assert sorted(map(tuple, ours.select(cols).collect())) == sorted(map(tuple, theirs.select(cols).collect()))
    none = run_daily(spark, items, None, runs, *paths, answers=docs.limit(0), commit=False)
    header = {r.run_ts: r for r in none["header"].collect()}
    shown = {r.run_ts: r["count"] for r in none["digest_items"].groupBy("run_ts").count().collect()}
    assert header and all(h.is_fallback and h.n_kept == shown[k] for k, h in header.items())
    assert {h.summary for h in header.values()} == {vocab.DIGEST_FALLBACK_SUMMARY}


def test_unusable_answers(spark):
    from feedlake.operators import verdicts as V
    from feedlake.operators import weekly as W
    docs = [("obj", '{"items": []}'), ("ref", '{"articles_analyses": [{}]}'), ("nolist", '{"items": 3}'), ("none", "{}"),
            ("arr", "[1,2]"), ("cut", '{"items": ['), ("null", None)]
    got = {r.k: r.usable for r in V.usable(spark.createDataFrame(docs, "k string, doc string"), "k").collect()}
    assert {k for k, ok in got.items() if ok} == {"obj", "ref"}
    weekly = spark.createDataFrame([("w1", '{"tendances": "t"}'), ("w2", "[1,2]"), ("w3", "7")], "week string, doc string")
    assert {r.week for r in W.recap_fields(weekly).filter("usable").collect()} == {"w1"}


def test_empty_run_header(spark):
    from datetime import datetime

    from feedlake.operators import verdicts as V
    t = [datetime(2024, 1, d) for d in (1, 2)]
    items = spark.createDataFrame([(t[0], "h")], "run_ts timestamp_ntz, hash string")
    verdicts = spark.createDataFrame([(t[0], True)], "run_ts timestamp_ntz, kept boolean")
    docs = spark.createDataFrame([(t[0], '{"tldr": "x"}')], "run_ts timestamp_ntz, doc string")
    runs = spark.createDataFrame([(x,) for x in t], "run_ts timestamp_ntz")
    got = {r.run_ts: r for r in V.digest_header(items, verdicts, docs, runs=runs).collect()}
    assert got[t[0]].headline == "x" and got[t[1]].summary == vocab.DIGEST_EMPTY_SUMMARY and got[t[1]].n_scored == 0
