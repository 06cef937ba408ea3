"""Streams with state of their own: the ledger with retention, weeks that close."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedlake.operators import ledger as LG
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx
from feedlake.streaming import ledger as SL
from feedlake.streaming import weeks as SW

MARKS = "hash string, url string, seen_at timestamp_ntz"


def test_openings_do_not_depend_on_the_order_of_arrival():
    """Marks held between batches are enough: any order within the lateness gives the rows of the sorted marks."""
    rng = random.Random(5)
    for _ in range(400):
        retention, late = rng.randrange(1, 40), rng.randrange(1, 60)
        marks = sorted({(rng.randrange(150), rng.choice("ab")) for _ in range(rng.randrange(1, 25))})
        marks = sorted({s: u for s, u in reversed(marks)}.items())
        arrival = sorted(marks, key=lambda m: m[0] + rng.randrange(late))
        held, watermark, done = [], -1, []
        while arrival:
            n = rng.randrange(1, 5)
            batch, arrival = arrival[:n], arrival[n:]
            held = sorted({**dict(held), **{m[0]: m[1] for m in batch if m[0] > watermark}}.items())
            held = SL.still_needed(held, retention, watermark)
            done.append(SL.opening(held, retention))
            watermark = max(watermark, max(m[0] for m in batch) - late)
            gone = [m for m in held if m not in SL.still_needed(held, retention, watermark)]
            assert all(m in SL.opening(held, retention) and m[0] + retention < watermark or m not in SL.opening(held, retention)
                       for m in gone)
            held = SL.still_needed(held, retention, watermark)
        end = marks[-1][0]
        live = lambda rows: [m for m in rows if m[0] >= end - retention]
        assert live(SL.opening(held, retention)) == live(SL.opening(marks, retention))


class _Handle:
    """Stands for Spark's handle: one value, and the timers."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def _fed(batches, retention, watermarks):
    """Last snapshot of each hash of one bucket, and what the state holds at the end."""
    from types import SimpleNamespace

    import pandas as pd
    handle, last = _Handle(), {}
    ledger = SL.LedgerProcessor(retention)
    ledger.init(handle)
    for batch, at in zip(batches, watermarks, strict=True):
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda at=at: at)
        out = list(ledger.handleInputRows((0,), iter([pd.DataFrame(batch, columns=["hash", "url", "seen_us"])]), now)) if batch else []
        for t in sorted(t for t in handle.timers if t <= at):
            handle.timers.remove(t)
            out += ledger.handleExpiredTimer((0,), now, None)
        for r in (r for d in out for r in d.itertuples()):
            last[r.hash] = list(zip(r.seen, r.url))
    return last, sorted(zip(*handle.value[:3])) if handle.value else [], handle.timers


def test_hashes_of_a_bucket_are_kept_as_those_of_buckets_of_their_own():
    rng = random.Random(11)
    for _ in range(60):
        marks = [(rng.choice("pqrs"), rng.choice("ab"), 1000 * rng.randrange(200)) for _ in range(rng.randrange(1, 50))]
        marks.sort(key=lambda m: m[2] + 1000 * rng.randrange(30))
        batches = [marks[i:i + 6] for i in range(0, len(marks), 6)] + [[]]
        watermarks, at = [], 0
        for b in batches:
            watermarks.append(at)
            at = max([at, *(m[2] // 1000 - 30 for m in b)])
        watermarks[-1] = at
        retention = 1000 * rng.randrange(1, 60)
        last, held, timers = _fed(batches, retention, watermarks)
        alone = [_fed([[m for m in b if m[0] == h] for b in batches], retention, watermarks) for h in "pqrs"]
        assert last == {h: rows for x in alone for h, rows in x[0].items()}
        opens = lambda held, h: SL.opening([m[1:] for m in held if m[0] == h], retention)
        assert all(opens(held, h) == opens(x[1], h) for h, x in zip("pqrs", alone, strict=True))
        assert timers == ({min(t for x in alone for t in x[2])} if held else set())


def _land(spark, path, rows):
    spark.createDataFrame(rows, MARKS).coalesce(1).write.mode("append").parquet(path)


def _ledger(spark, path, keep, **more):
    live = spark.readStream.schema(MARKS).option("maxFilesPerTrigger", 1).parquet(path)
    return SL.run_ledger(live, path=keep, **more)


def test_ledger_stream_purges_and_goes_on(spark):
    day = lambda d, h=0: datetime(2024, 1, 1) + timedelta(days=d, hours=h)
    path, keep = scratch_path(spark, "marks"), scratch_path(spark, "ledger-q")
    batches = [[("a", "u1", day(0)), ("b", "v1", day(0, 5))],
               [("a", "u2", day(3)), ("b", "v0", day(0, 4)), (None, "x", day(1)), ("c", None, day(2))],
               [("b", "v3", day(11)), ("d", "w", day(12))],
               [("a", "u9", day(13, 1)), ("d", "w0", day(12))]]
    for b in batches[:2]:
        _land(spark, path, b)
    out = _ledger(spark, path, keep, days=10, late="1 day")
    first = {(r.hash, r.url, r.seen_at) for r in SL.ledger_rows(spark, out).collect()}
    assert first == {("a", "u1", day(0)), ("b", "v0", day(0, 4)), ("c", "", day(2))}
    for b in batches[2:]:  # the query is started again and finds its state
        _land(spark, path, b)
    out = _ledger(spark, path, keep, days=10, late="1 day")
    rows = {(r.hash, r.url, r.seen_at) for r in SL.ledger_rows(spark, out).collect()}
    # the first rows of a and b ran out at days 10 and 10.2; later marks opened new ones; c's runs out on day 12
    assert rows == {("a", "u9", day(13, 1)), ("b", "v3", day(11)), ("d", "w", day(12))}
    marks = spark.createDataFrame([m for b in batches for m in b if m[0]], MARKS)
    whole = LG.purge(LG.openings(marks.fillna("", ["url"]), 10), F.lit(day(13, 1)), 10)
    assert rows == set(map(tuple, whole.select("hash", "url", "seen_at").collect()))
    state = spark.read.format("statestore").option("stateVarName", "marks").load(f"{keep}/progress")
    assert state.count() == 3  # what ran out is gone from the state


@pytest.mark.parametrize("parts", [1, 16])
def test_weeks_close_and_are_rebuilt(spark, base, monkeypatch, parts):
    monkeypatch.setattr(SW, "PARTS", parts)
    rows = (fx.daily_verdicts(spark, base).filter("kept")
            .select("run_ts", "published_at", "hash", "entry_id", "severity", "score", "category"))
    path = scratch_path(spark, "v-files")
    cut = datetime(2024, 1, 16)
    for inside in (F.col("run_ts") < F.lit(cut), F.col("run_ts") >= F.lit(cut)):
        rows.filter(inside).coalesce(1).write.mode("append").parquet(path)
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {(r.week, r.edition): r for r in SW.read_recaps(spark, SW.run_weeks(live)).collect()}
    all_rows = rows.collect()
    rank = {"critical": 0, "important": 1, "notable": 2}
    due = lambda r: r.published_at.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(
        days=r.published_at.weekday()) + timedelta(days=6, hours=15)
    week = lambda r: "%d-W%02d" % r.published_at.isocalendar()[:2]
    last, want = max(r.run_ts for r in all_rows), {}
    for w in {week(r) for r in all_rows}:
        mine = [r for r in all_rows if week(r) == w]
        if due(mine[0]) > last or not any(r.run_ts <= due(r) for r in mine):
            continue
        late = [r for r in mine if r.run_ts > due(r)]
        for edition, own in (("closed", [r for r in mine if r.run_ts <= due(r)]), ("rebuilt", mine)):
            if edition == "closed" or late:
                first = sorted(own, key=lambda r: (rank.get(r.severity, 3), -r.score, r.published_at, r.hash, r.entry_id))[:3]
                want[w, edition] = (len(own), len(late) if edition == "rebuilt" else 0, ",".join(str(r.entry_id) for r in first))
    assert {k: (r.n_kept, r.n_late, r.top) for k, r in got.items()} == want and any(e == "rebuilt" for _, e in want)
    assert all(sum(int(c.split(":")[1]) for c in r.counts.split(",")) == r.n_kept for r in got.values())
