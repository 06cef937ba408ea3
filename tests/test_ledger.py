"""Ledger, multi-run dedup and upsert."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedlake.operators import ledger as LG
from feedlake.operators import recency as R
from feedlake.operators import verdicts as V
from feedlake.session import delete_path, scratch_path
from feedlake.sources import fixtures as fx
from feedlake.sources import store as ST


def test_anti_join_keeps_batch_duplicates(spark):
    items = spark.createDataFrame([("h1", 1), ("h2", 2), ("h1", 3), ("h3", 4)], "hash string, pos int")
    ledger = spark.createDataFrame([("h2", "u", datetime(2026, 1, 1))], "hash string, url string, seen_at timestamp_ntz")
    assert sorted(r.pos for r in LG.new_items(items, ledger).collect()) == [1, 3, 4]
    empty = ledger.limit(0)
    assert LG.new_items(items, empty).count() == 4
    full = spark.createDataFrame([(h, "u", datetime(2026, 1, 1)) for h in ["h1", "h2", "h3"]], ledger.schema)
    assert LG.new_items(items, full).count() == 0


def test_first_write_wins(spark):
    t0 = datetime(2026, 1, 1)
    marks = spark.createDataFrame([("h", "first", t0), ("h", "second", t0 + timedelta(days=1))],
                                  "hash string, url string, seen_at timestamp_ntz")
    r = LG.first_wins(marks).first()
    assert (r.url, r.seen_at) == ("first", t0)


def test_multi_run_equals_sequential_loop(spark, base):
    """Closed-form dedup over all runs = running the daily job run after run."""
    v = fx.verdicts(spark, base)
    runs = fx.runs(spark, base)
    status = fx.run_status(spark, base)
    prior = fx.ledger(spark, base)
    closed = {(r.run_ts, r.entry_id) for r in
              LG.new_per_run(R.items_per_run(v, runs), prior, status).collect()}
    # sequential loop on the driver (small data only, as the reference does)
    items = [(r.entry_id, r.hash, r.published_at) for r in v.select("entry_id", "hash", "published_at").collect()]
    seen = {r.hash for r in prior.collect()}
    ok = {r.run_ts: r.ok for r in status.collect()}
    loop = set()
    for run in sorted(ok):
        batch = [(e, h) for e, h, p in items if p <= run and p >= run - timedelta(hours=24)]
        new = [(e, h) for e, h in batch if h not in seen]
        loop |= {(run, e) for e, _ in new}
        if ok[run]:
            seen |= {h for _, h in new}
    assert closed == loop


def test_upsert_idempotent_last_wins(spark):
    t = datetime(2026, 1, 1)
    store = spark.createDataFrame([("h", t, 1, "a")], "hash string, recorded_at timestamp_ntz, response_pos int, v string")
    batch = spark.createDataFrame([("h", t + timedelta(days=1), 1, "b"), ("k", t, 2, "c")], store.schema)
    once = V.upsert(store, batch)
    twice = V.upsert(once, batch)
    assert {(r.hash, r.v) for r in once.collect()} == {("h", "b"), ("k", "c")}
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("hours", [1, 24, 696, 744, 2160])
def test_items_per_run_equals_direct_join(spark, hours):
    """Windows of any length; items landing late, dated far ahead or before the first run."""
    base = datetime(2024, 1, 1)
    rows = [(i, base + timedelta(hours=7 * i - 900), base + timedelta(hours=7 * i - 900 + 31 * (i % 4)))
            for i in range(250)]
    rows += [(900, datetime(2124, 1, 1), base), (901, datetime(2024, 1, 9, 3), datetime(2024, 1, 8, 3)),
             (902, datetime(2030, 1, 1), datetime(2029, 1, 1))]
    items = spark.createDataFrame(rows, "entry_id int, published_at timestamp_ntz, fetched_at timestamp_ntz")
    runs = [base + timedelta(days=d, hours=3) for d in range(0, 40, 2)]
    got = R.items_per_run(items, spark.createDataFrame([(r,) for r in runs], "run_ts timestamp_ntz"), hours, "fetched_at")
    want = {(r, i) for r in runs for i, p, f in rows if f <= r and p >= r - timedelta(hours=hours)}
    pairs = [(r.run_ts, r.entry_id) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_missing_run_status_is_not_published(spark):
    """One rule for dedup and marks: a run without a status row has not published."""
    t = [datetime(2024, 1, d, 3) for d in (1, 2)]
    pairs = spark.createDataFrame([(t[0], "h", "l"), (t[1], "h", "l")], "run_ts timestamp_ntz, hash string, link string")
    ledger = spark.createDataFrame([], "hash string, url string, seen_at timestamp_ntz")
    status = spark.createDataFrame([(t[1], True)], "run_ts timestamp_ntz, ok boolean")
    new = LG.new_per_run(pairs, ledger, status)
    assert new.count() == 2
    assert [r.run_ts for r in LG.gated_marks(new, status).collect()] == [t[1]]


def test_purge_drops_days_and_keeps_the_rest(spark):
    path = scratch_path(spark, "purge")
    marks = spark.createDataFrame([("a", "u", datetime(2024, 1, 1)), ("b", "u", datetime(2024, 1, 10, 3)),
                                   ("c", "u", datetime(2024, 1, 10, 13)), ("a", "u", datetime(2024, 1, 20)),
                                   ("d", "u", datetime(2024, 1, 2))], "hash string, url string, seen_at timestamp_ntz")
    ST.append_ledger(marks, path)
    assert ST.purge_ledger(spark, path, "2024-01-20 12:00:00", days=10) == 2     # b and d; a has a later mark
    assert {r.hash for r in ST.read_ledger(spark, path).collect()} == {"a", "c"}
    assert ST.purge_ledger(spark, path, "2024-01-20 12:00:00", days=10) == 0


def _verdict_rows(spark, rows):
    return spark.createDataFrame([(h, d, True, d + timedelta(days=1), i) for i, (h, d) in enumerate(rows)],
                                 "hash string, published_at timestamp_ntz, kept boolean, recorded_at timestamp_ntz, response_pos int")


def test_upsert_finds_weeks_by_the_locator(spark, monkeypatch):
    """A commit reads the locator's partitions of its hashes and the weeks it touches, never the whole store."""
    path = scratch_path(spark, "located")
    weeks = [datetime(2024, 1, 1) + timedelta(days=7 * k) for k in range(12)]
    ST.upsert_store(spark, _verdict_rows(spark, [(f"k{i}", weeks[i % 12]) for i in range(240)]), path)
    own = spark.createDataFrame([("k5",)], "hash string")
    plan = ST.weeks_of(spark, own, path)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*prefix#\d+ (IN|=)", plan)
    assert {r.week for r in ST.weeks_of(spark, own, path).collect()} == {"2024-W06"}
    read = []
    real = ST.read_store

    def watched(spark_, path_, wanted=None):
        read.append(sorted(wanted))
        df = real(spark_, path_, wanted)
        assert re.search(r"PartitionFilters: \[[^\]]*week#\d+ (IN|=)", df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(ST, "read_store", watched)
    ST.upsert_store(spark, _verdict_rows(spark, [("k5", weeks[7] + timedelta(days=1)), ("new", weeks[2])]), path)
    assert read == [["2024-W03", "2024-W06", "2024-W08"]]
    monkeypatch.undo()
    rows = ST.read_store(spark, path)
    assert rows.count() == 241 and rows.select("hash").distinct().count() == 241
    assert {r.week for r in rows.filter("hash = 'k5'").collect()} == {"2024-W08"}


def test_lost_locator_is_rebuilt_and_crashes_leave_one_row_per_hash(spark, monkeypatch):
    path = scratch_path(spark, "located-2")
    a, b, c = (datetime(2024, 1, 1) + timedelta(days=7 * k) for k in range(3))
    ST.upsert_store(spark, _verdict_rows(spark, [("x", a), ("y", a)]), path)
    delete_path(spark, ST.locator_path(path))

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(ST, "apply_upsert", dies)  # the locator knows more than the store has
    with pytest.raises(KeyboardInterrupt):
        ST.upsert_store(spark, _verdict_rows(spark, [("x", b)]), path)
    monkeypatch.undo()
    assert {(r.hash, r.week) for r in ST.read_store(spark, path).collect()} == {("x", "2024-W01"), ("y", "2024-W01")}
    ST.upsert_store(spark, _verdict_rows(spark, [("x", c)]), path)
    ST.upsert_store(spark, _verdict_rows(spark, [("x", c)]), path)
    assert {(r.hash, r.week) for r in ST.read_store(spark, path).collect()} == {("x", "2024-W03"), ("y", "2024-W01")}
    ST.rebuild_locator(spark, path)
    assert {r.week for r in ST.weeks_of(spark, spark.createDataFrame([("x",)], "hash string"), path).collect()} == {"2024-W03"}


def test_bucketed_ledger_joins_without_a_shuffle_of_its_own(spark, base):
    path, plain = scratch_path(spark, "bucketed"), scratch_path(spark, "plain")
    ST.create_ledger(spark, path, 8)
    assert ST.read_ledger(spark, path).count() == 0 and ST.purge_ledger(spark, path, "2024-01-01 00:00:00") == 0
    marks = fx.ledger(spark, base)
    for part in (marks.filter("seen_at < '2024-01-08'"), marks.filter("seen_at >= '2024-01-08'")):
        ST.append_ledger(part, path)
        ST.append_ledger(part, plain)
    rows = lambda p: sorted(map(tuple, ST.read_ledger(spark, p).collect()))
    assert rows(path) == rows(plain)
    items = fx.verdicts(spark, base).select("hash", "entry_id")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        new = LG.new_items(items, ST.read_ledger_log(spark, path))
        lines = new._jdf.queryExecution().executedPlan().toString().splitlines()
        want = sorted(map(tuple, LG.new_items(items, ST.read_ledger_log(spark, plain)).collect()))
        assert sorted(map(tuple, new.collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = next(i for i, line in enumerate(lines) if "feedlake_ledger_" in line or "Bucketed: true" in line)
    assert "Bucketed: true" in lines[scan]
    above, at = [], depth(lines[scan])  # the operators between the ledger's scan and its join
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            at = depth(line)
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    # purge still goes by day: whole days as folders, the cut's own day anew, in its buckets
    now = "2024-01-14 12:00:00"
    assert ST.purge_ledger(spark, path, now, days=7) == ST.purge_ledger(spark, plain, now, days=7) > 0
    assert rows(path) == rows(plain) and rows(path)[0][2] >= datetime(2024, 1, 7, 12)
    ST.append_ledger(marks.limit(3).withColumn("seen_at", F.lit(datetime(2024, 1, 14)).cast("timestamp_ntz")), path)
    assert ST.read_ledger_log(spark, path).filter("seen_at = '2024-01-14'").count() == 3
