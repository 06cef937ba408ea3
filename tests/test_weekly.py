"""Weekly rollups, report document invariants and the report sink."""

import glob
import re

from pyspark.sql import functions as F

from feedlake.operators import report as RP
from feedlake.operators import weekly as W
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx


def test_takeaways_cut_then_drop_blanks(spark):
    docs = spark.createDataFrame([("2026-W22", '{"a_retenir": [" a ", "", "b", "c"]}')],
                                 "week string, doc string")
    got = [(r.rank, r.text) for r in W.takeaways(W.recap_fields(docs)).orderBy("rank").collect()]
    assert got == [(1, "a"), (2, "b")]


def test_top_referenced_order_unknown_repeat(spark):
    store = spark.createDataFrame(
        [("W", "h1", 1, "2026-05-26 12:00:00"), ("W", "h2", 2, "2026-05-26 13:00:00"),
         ("W", "h3", 3, "2026-05-26 14:00:00")],
        "week string, hash string, entry_id int, published_at string") \
        .withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
    docs = spark.createDataFrame([("W", '{"top_3_hashes": ["h3", "zz", "h1", "h2"]}')],
                                 "week string, doc string")
    got = [(r.rank, r.hash) for r in W.top_referenced(store, W.recap_fields(docs)).orderBy("rank").collect()]
    assert got == [(1, "h3"), (2, "h1")]


def test_report_invariants_and_sink(spark, base):
    store = fx.store(spark, base)
    fields = W.recap_fields(fx.recap_docs(spark, base))
    lines = RP.weekly_report_lines(store, fields)
    path = scratch_path(spark, "report-test")
    RP.write_weekly_report(lines, path)
    totals = {r.week: r.n_kept for r in W.week_totals(store).collect()}
    files = sorted(glob.glob(f"{path}/*.md"))
    by_week = {}
    for f in files:
        wk = re.search(r"([^/]+)\.md$", f).group(1)
        by_week[wk] = by_week.get(wk, "") + open(f, encoding="utf-8").read()
    assert set(by_week) == set(totals)
    for wk, doc in by_week.items():
        retained = int(re.search(r"\*\*Articles retenus\*\* : (\d+)", doc).group(1))
        table = sum(int(x) for x in re.findall(r"^\| \S+ [^|]+ \| (\d+) \|$", doc, re.M))
        bullets = len(re.findall(r"^- \[", doc, re.M))
        assert retained == table == bullets == totals[wk]
        assert doc.endswith("\n") and doc.startswith("# Récap veille — Semaine ")
    # overwriting one week leaves the others in place
    one = lines.filter(F.col("week") == sorted(totals)[0])
    RP.write_weekly_report(one, path)
    assert len(glob.glob(f"{path}/*.md")) == len(totals)


def test_category_counts_zero_fill(spark):
    store = spark.createDataFrame([("W1", "security"), ("W1", "ai"), ("W2", "general")],
                                  "week string, category string")
    got = W.category_counts(store).filter("week = 'W1'").orderBy("ord").collect()
    assert [(r.category, r.n) for r in got] == [("security", 1), ("backend", 0), ("frontend", 0),
                                                ("devops", 0), ("ai", 1), ("general", 0)]
