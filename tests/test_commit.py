"""The job's commit: journal and replay, order of the steps, requests against answers."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedlake.operators import ledger as LG
from feedlake.operators import verdicts as V
from feedlake.plans.daily import run_daily
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx
from feedlake.sources import journal as J
from feedlake.sources import store as ST

RUN = datetime(2024, 1, 9, 3)


class Killed(BaseException):
    """Stands for the process going away: no handler of the job runs."""


def _items(spark, n=60, run=RUN):
    rows = [(f"h{i:03}", f"https://x.example.org/{i}", f"Title {i}", "text", "s", "security", run - timedelta(hours=2), i)
            for i in range(n)]
    return spark.createDataFrame(rows, "hash string, link string, title string, summary string, source string, "
                                       "source_category string, published_at timestamp_ntz, entry_pos long").withColumn(
        "entry_id", F.col("entry_pos"))


def _answer(hashes):
    return json.dumps({"headline": "head", "items": [{"hash": h, "severity": "important", "score": 7, "kept": True,
                                                       "category": "backend", "reason": "r"} for h in hashes]})


def _runs(spark):
    return spark.createDataFrame([(RUN,)], "run_ts timestamp_ntz")


def _answers(spark, docs):
    return spark.createDataFrame([(RUN, p, d) for p, d in docs], "run_ts timestamp_ntz, first_pos int, doc string")


def _state(spark, ledger, store):
    return (sorted(map(tuple, ST.read_ledger(spark, ledger).collect())),
            sorted(map(tuple, ST.read_store(spark, store).collect())))


def _job(spark, paths, **more):
    ledger, store, journal = paths
    docs = [(0, _answer([f"h{i:03}" for i in range(50)]))]
    return run_daily(spark, _items(spark), None, _runs(spark), ledger, store, answers=_answers(spark, docs),
                     journal_path=journal, **more)


def _paths(spark):
    return [scratch_path(spark, n) for n in ("c-ledger", "c-store", "c-journal")]


def _old_store(spark, store):
    """A stored verdict that the job replaces, in another week, and one that it leaves."""
    old = spark.createDataFrame([("h001", datetime(2023, 12, 20), True, datetime(2023, 12, 21), 1),
                                 ("other", datetime(2023, 12, 20), True, datetime(2023, 12, 21), 2)],
                                "hash string, published_at timestamp_ntz, kept boolean, recorded_at timestamp_ntz, response_pos int")
    ST.upsert_store(spark, old, store)


def _commit(spark, paths, publish):
    """The commit part of a job, of a few rows."""
    day = datetime(2024, 1, 8)
    J.recover(spark, paths[2], publish, *paths[:2])
    marked = {r.hash for r in ST.read_ledger_log(spark, paths[0]).collect()}
    new = [(RUN, h, f"https://x/{h}") for h in ("h000", "h001", "h002") if h not in marked]
    if not new:
        return 0
    items = spark.createDataFrame(new, "run_ts timestamp_ntz, hash string, link string")
    rows = items.withColumns({"published_at": F.lit(day).cast("timestamp_ntz"), "kept": F.lit(True),
                              "recorded_at": F.col("run_ts"), "response_pos": F.lit(1).cast("bigint")})
    payloads = spark.createDataFrame([(RUN, "payload")], "run_ts timestamp_ntz, payload string")
    status = spark.createDataFrame([(RUN, True)], "run_ts timestamp_ntz, ok boolean")
    entry = J.prepare(spark, paths[2], payloads, items, rows, status)
    J.complete(spark, entry, publish, *paths[:2])
    return len(new)


def test_a_killed_commit_is_completed_by_the_next(spark, monkeypatch):
    """Killed before or after each step's marker: the next job leaves what one that was not killed leaves."""
    whole, sent = _paths(spark), []

    def publish(payload):
        sent.append([r.payload for r in payload.collect()])

    _old_store(spark, whole[1])
    assert _commit(spark, whole, publish) == 3
    want = _state(spark, *whole[:2])
    real = J.mark_done
    for step in J.STEPS:
        for when in ("before", "after"):
            killed = _paths(spark)
            _old_store(spark, killed[1])

            def dies(spark_, entry, name, step=step, when=when):
                if name == step and when == "before":
                    raise Killed
                real(spark_, entry, name)
                if name == step:
                    raise Killed

            monkeypatch.setattr(J, "mark_done", dies)
            with pytest.raises(Killed):
                _commit(spark, killed, publish)
            monkeypatch.setattr(J, "mark_done", real)
            again = _commit(spark, killed, publish)
            assert _state(spark, *killed[:2]) == want, (step, when)
            assert J.entries(spark, killed[2]) == []
            # before it is prepared nothing was published: the next job does it all by itself
            assert again == (3 if (step, when) == ("prepared", "before") else 0)
    assert set(map(tuple, sent)) == {("payload",)}


def test_a_killed_job_is_completed_by_the_next(spark, monkeypatch):
    killed, sent = _paths(spark), []

    def publish(payload):
        sent.append(sorted(r.payload for r in payload.collect()))

    def dies(*_):
        raise Killed

    monkeypatch.setattr(ST, "append_ledger", dies)
    with pytest.raises(Killed):
        _job(spark, killed, publish=publish)
    monkeypatch.undo()
    assert ST.read_ledger(spark, killed[0]).count() == 0 and len(J.entries(spark, killed[2])) == 1
    assert _job(spark, killed, publish=publish)["new"].count() == 0
    assert ST.read_ledger(spark, killed[0]).count() == 60 == ST.read_store(spark, killed[1]).count()
    assert [p for p in sent if p] == sent[:1] and len(sent[0]) == 1


def test_half_replaced_store_is_mended(spark, monkeypatch):
    """Killed while weeks are replaced: the replay puts them in place from the entry, not from what is left."""
    paths, whole = _paths(spark), _paths(spark)
    for p in (paths, whole):
        _old_store(spark, p[1])
    _commit(spark, whole, None)

    def half(spark_, staging, path):
        ST.delete_path(spark_, path)
        raise Killed

    real = ST.apply_upsert
    monkeypatch.setattr(ST, "apply_upsert", half)
    with pytest.raises(Killed):
        _commit(spark, paths, None)
    monkeypatch.setattr(ST, "apply_upsert", real)
    assert J.recover(spark, paths[2], None, *paths[:2]) == 1 and J.recover(spark, paths[2], None, *paths[:2]) == 0
    assert _state(spark, *paths[:2]) == _state(spark, *whole[:2])
    assert {"other"} <= {r.hash for r in ST.read_store(spark, paths[1]).collect()}


def test_failing_publication_leaves_no_entry(spark):
    paths = _paths(spark)

    def publish(payload):
        raise OSError("no way out")

    with pytest.raises(OSError):
        _job(spark, paths, publish=publish)
    assert J.entries(spark, paths[2]) == [] and _state(spark, *paths[:2]) == ([], [])
    assert _job(spark, paths)["new"].count() == 60


def test_runs_that_did_not_publish_commit_nothing(spark):
    paths = _paths(spark)
    failed = spark.createDataFrame([(RUN, False)], "run_ts timestamp_ntz, ok boolean")
    _job(spark, paths, publish=lambda payload: failed)
    assert _state(spark, *paths[:2]) == ([], [])


def test_store_is_written_before_the_ledger(spark, monkeypatch):
    paths = _paths(spark)

    def dies(*_):
        raise Killed

    monkeypatch.setattr(ST, "append_ledger", dies)
    with pytest.raises(Killed):
        run_daily(spark, _items(spark), None, _runs(spark), *paths[:2], answers=_answers(spark, [(0, _answer(["h000"]))]))
    monkeypatch.undo()
    assert ST.read_ledger(spark, paths[0]).count() == 0 and ST.read_store(spark, paths[1]).count() == 60


def test_a_request_without_an_answer_is_shown(spark):
    """60 items are two requests; nothing answers the second: its items are shown as fallback rows."""
    paths = _paths(spark)
    out = run_daily(spark, _items(spark), None, _runs(spark), *paths[:2],
                    answers=_answers(spark, [(0, _answer([f"h{i:03}" for i in range(50)])), (50, "{broken")]))
    shown = {r.hash: r for r in out["digest_items"].collect()}
    assert len(shown) == 60 and out["requests"].count() == 2
    assert {h for h, r in shown.items() if r.is_fallback} == {f"h{i:03}" for i in range(50, 60)}
    assert all(r.section == "other" and r.severity == "notable" for r in shown.values() if r.is_fallback)
    assert {r.hash for r in ST.read_ledger(spark, paths[0]).collect()} == set(shown)
    header = out["header"].first()
    assert not header.is_fallback and header.n_kept == 60 and header.headline == "head"
    plain = run_daily(spark, _items(spark), None, _runs(spark), *_paths(spark)[:2], commit=False, show_unanswered=False,
                      answers=_answers(spark, [(0, _answer([f"h{i:03}" for i in range(50)]))]))
    assert plain["digest_items"].count() == 50


def test_a_run_on_the_fallback_may_mark_what_it_shows_only(spark):
    paths = _paths(spark)
    out = run_daily(spark, _items(spark), None, _runs(spark), *paths[:2], answers=_answers(spark, [(0, "nothing")]),
                    mark_unshown=False)
    shown = {r.hash for r in out["digest_items"].collect()}
    assert len(shown) == 8 and {r.hash for r in ST.read_ledger(spark, paths[0]).collect()} == shown


def test_answers_are_asked_for_in_bounded_rounds(spark):
    asked = []

    def ask(requests, attempt):
        own = [(r.run_ts, r.batch_no) for r in requests.select("run_ts", "batch_no").collect()]
        asked.append((attempt, sorted(b for _, b in own)))
        # request 0 answers at once, 1 in the second round, 2 never
        rows = [(t, b, _answer([f"h{i:03}" for i in range(50 * b, 50 * b + 50)]) if attempt > b and b < 2 else "sorry")
                for t, b in own if not (b == 2 and attempt == 2)]
        return spark.createDataFrame(rows, "run_ts timestamp_ntz, batch_no long, doc string")

    out = run_daily(spark, _items(spark, 130), None, _runs(spark), *_paths(spark)[:2], ask=ask)
    assert asked == [(1, [0, 1, 2]), (2, [1, 2]), (3, [2])]
    shown = {r.hash: r.is_fallback for r in out["digest_items"].collect()}
    assert len(shown) == 130 and sum(shown.values()) == 30
    asked.clear()
    run_daily(spark, _items(spark, 10), None, _runs(spark), *_paths(spark)[:2], ask=ask)
    assert asked == [(1, [0])]


def test_reconciliation_of_hashes(spark):
    sent = spark.createDataFrame([(RUN, b, h) for b, h in [(0, "a"), (0, "b"), (0, "b"), (1, "c"), (1, "d"), (2, "e")]],
                                 "run_ts timestamp_ntz, batch_no long, hash string")
    answered = spark.createDataFrame([(RUN, h) for h in ("a", "b", "b", "c", "x")], "run_ts timestamp_ntz, hash string")
    got = {r.batch_no: (r.n_sent, r.n_answered, r.n_missing, r.n_repeated, r.status) for r in V.reconcile(sent, answered).collect()}
    assert got == {0: (2, 2, 0, 1, "answered"), 1: (2, 1, 1, 0, "partial"), 2: (1, 0, 1, 0, "unanswered")}


def test_two_header_documents_give_one_header(spark):
    docs = [(0, _answer(["h000"])), (0, _answer(["h001"]).replace("head", "also"))]
    out = run_daily(spark, _items(spark, 5), None, _runs(spark), *_paths(spark)[:2], answers=_answers(spark, docs), commit=False)
    assert [r.headline for r in out["header"].collect()] == ["also"] and out["payload"].count() == 1


def test_openings_equal_a_loop(spark, base):
    marks = fx.verdicts(spark, base).select("hash", F.col("link").alias("url"), F.col("published_at").alias("seen_at"))
    rows, want = sorted(marks.collect(), key=lambda r: (r.seen_at, r.url)), {}
    for r in rows:
        own = want.setdefault(r.hash, [])
        if not own or r.seen_at > own[-1][1] + timedelta(days=5):
            own.append((r.url, r.seen_at))
    got = LG.openings(marks, 5).collect()
    assert sorted((r.hash, r.url, r.seen_at) for r in got) == sorted((h, *x) for h, own in want.items() for x in own)
    assert any(len(x) > 1 for x in want.values())
